"""Row filters and sampling. None but the repeatable sample of repeated rows shuffles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.session import broadcast_if_small, cut_lineage

#: Steps of the probability that a row is kept with, and copies of one row that a task draws.
SAMPLE_STEPS = 1_000_000_000
SAMPLE_LOT = 100_000


def grep(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Rows whose whole text matches the pattern."""
    return df.filter(F.col(column).rlike(rf"\A(?:{pattern})\z"))


def at_least(df: DataFrame, column: str, threshold) -> DataFrame:
    return df.filter(F.col(column) >= threshold)


def contains_text(column: str | Column, part: str) -> Column:
    """Substring predicate without regard to case."""
    text = F.col(column) if isinstance(column, str) else column
    return F.lower(text).contains(part.lower())


def not_category(df: DataFrame, column: str, category) -> DataFrame:
    """Rows not in the category; a missing category is kept."""
    return df.filter(~F.col(column).eqNullSafe(category))


def sample_percent(df: DataFrame, percent: float, seed: int = 0) -> DataFrame:
    """Every row is kept with the given probability, on its own."""
    return df.sample(withReplacement=False, fraction=percent / 100.0, seed=seed)


def sample_repeatable(df: DataFrame, percent: float, seed: int = 0, *, lot: int = SAMPLE_LOT) -> DataFrame:
    """Every row is kept with the given probability, by a hash of its values and of its copy number alone.

    So the sample does not depend on how the rows lie in files and tasks, a larger percentage holds the rows of a smaller
    one, and copies of a row are drawn on their own. Only the hashes of the rows are shuffled, to find the rows that
    repeat; those are counted, and the copies of one row are drawn by as many tasks as ``lot`` goes into their number.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    whole, copy = F.struct(*columns), F.col("_copy")
    bound = F.lit(round(percent / 100 * SAMPLE_STEPS))
    drawn = F.pmod(F.xxhash64(F.lit(seed), "_hash", copy), F.lit(SAMPLE_STEPS)) < bound
    rows = df.select(whole.alias("_whole"), F.xxhash64(F.lit("row"), *columns).alias("_hash"))
    repeated = rows.groupBy("_hash").agg(F.count("*").alias("_n")).where("_n > 1").select("_hash")
    repeated = broadcast_if_small(cut_lineage(repeated))
    once = rows.join(repeated, "_hash", "left_anti").withColumn("_copy", F.lit(0).cast("bigint"))
    counted = rows.join(repeated, "_hash", "left_semi").groupBy("_whole", "_hash").agg(F.count("*").alias("_n"))
    lots = counted.withColumn("_lot", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(_n - 1) div {lot}"))))
    first = F.col("_lot") * lot
    copies = lots.repartition("_hash", "_lot").withColumn("_copy", F.explode(F.sequence(first, F.least(first + lot, F.col("_n")) - 1)))
    kept = once.unionByName(copies.select("_whole", "_hash", "_copy")).where(drawn)
    return kept.select("_whole.*")


def without_nulls(df: DataFrame, *columns: str) -> DataFrame:
    """Rows with a value in each of the columns, or in all of them if none is named. NaN is a value."""
    return df.filter(reduce(Column.__and__, [F.col(f"`{c}`").isNotNull() for c in columns or df.columns]))
