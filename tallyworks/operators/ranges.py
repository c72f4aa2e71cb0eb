"""Running totals over ordered stretches of a table, without a window over all of its rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Stretches whose totals one task adds up.
FAN = 1024


def totals_before(totals: DataFrame, stretch: str, value: str, name: str = "before", *, fan: int = FAN) -> DataFrame:
    """Per stretch (a number from 0, one row each) the sum of ``value`` over all stretches with a smaller number.

    Two levels: ``fan`` neighbours are summed in one window, and so are the sums of such lots. A million stretches
    thus give windows of about a thousand rows. Null values count as nothing.
    """
    lot = F.floor(F.col(stretch) / fan).alias("_lot")
    rows = totals.select(F.col(stretch), F.coalesce(F.col(value), F.lit(0)).alias("_v"), lot)
    lots = rows.groupBy("_lot").agg(F.sum("_v").alias("_sum"))
    every = Window.orderBy("_lot").rowsBetween(Window.unboundedPreceding, -1)
    ahead = lots.select("_lot", F.coalesce(F.sum("_sum").over(every), F.lit(0)).alias("_ahead"))
    within = Window.partitionBy("_lot").orderBy(stretch).rowsBetween(Window.unboundedPreceding, -1)
    inside = rows.select(stretch, "_lot", F.coalesce(F.sum("_v").over(within), F.lit(0)).alias("_inside"))
    return inside.join(ahead, "_lot").select(stretch, (F.col("_inside") + F.col("_ahead")).alias(name))
