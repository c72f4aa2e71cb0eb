"""Exact medians of groups of any size, by narrowing down where the middle lies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.session import cut_lineage

#: Up to this many different values one task may hold the value counts of a group.
SMALL_DOMAIN = 100_000
#: Ranges the different values of a group are cut into in a round, and cut points compared at once to find a range.
RANGES = 256
BLOCK = 16


def _below(number: Column, cuts: Column, ends: Column, block: int) -> Column:
    """Number of cut points below a value: first whole blocks of them, known by their ends, then those of one block."""
    blocks = F.size(F.filter(ends, lambda c: c < number))
    rest = F.slice(cuts, blocks * block + 1, F.lit(block))
    return blocks * block + F.size(F.filter(rest, lambda c: c < number))


def _range_of(number: Column, cuts: list[float], block: int = BLOCK) -> Column:
    """Number of cut points of a list below a value."""
    return _below(number, F.lit(cuts), F.lit(cuts[block - 1 :: block] or [float("inf")]), block)


def _histogram(weighted: DataFrame, keys: Sequence[str], value: str, weight: str, ranges: int) -> tuple[DataFrame, DataFrame]:
    """Values with the range they lie in, and the ranges of every group: occurrences, and how many are below or inside.

    A group's different values are cut evenly, so how often a value occurs plays no part. The cut points need not be exact.
    """
    points = [i / ranges for i in range(1, ranges)]
    number = F.col(value).cast("double")
    cuts = weighted.groupBy(*keys).agg(F.array_sort(F.array_distinct(F.percentile_approx(number, points, 4 * ranges))).alias("_cuts"))
    cuts = cuts.withColumn("_ends", F.filter("_cuts", lambda c, i: i % BLOCK == BLOCK - 1))
    placed = weighted.join(cuts, list(keys)).withColumn("_range", _below(number, F.col("_cuts"), F.col("_ends"), BLOCK)).drop("_cuts", "_ends")
    bins = placed.groupBy(*keys, "_range").agg(
        F.sum(weight).alias("_n"), F.count("*").alias("_different"), F.min(value).alias("_low"), F.max(value).alias("_high"), F.first("_before").alias("_before"), F.first("_total").alias("_total")
    )
    upto = F.col("_before") + F.sum("_n").over(Window.partitionBy(*keys).orderBy("_range"))
    return placed, bins.withColumn("_upto", upto)


def exact_medians(
    weighted: DataFrame,
    keys: Sequence[str],
    value: str,
    weight: str,
    *,
    rows: DataFrame | None = None,
    small_domain: int = SMALL_DOMAIN,
    ranges: int = RANGES,
) -> DataFrame:
    """Median per group of values that come with their number of occurrences.

    ``weighted`` holds one row per group and value, so copies of a value cost nothing. With few different values overall, each
    group is resolved from its value counts. Otherwise it is narrowed down: the different values of a group are cut into
    ranges, the occurrences in each tell which range holds the middle, and only that range goes on, to be cut again
    until it has few values. A round leaves one value in ``ranges`` or so, however the occurrences are spread; a group with
    many values is never brought into one task, and the answer does not depend on how well the cut points are placed.

    The look at the values beforehand reads ``rows``, the uncounted input, when it is given, which spares a shuffle.
    """
    looked_at = weighted if rows is None else rows
    domain = looked_at.agg(F.approx_count_distinct(value)).first()[0]
    if domain <= small_domain:
        return weighted.groupBy(*keys).agg(F.percentile(value, 0.5, F.col(weight)).alias("median"))

    keys = list(keys)
    totals = weighted.groupBy(*keys).agg(F.sum(weight).alias("_total"), F.count("*").alias("_size"))
    left = weighted.select(*keys, value, weight).join(totals, keys).withColumn("_before", F.lit(0).cast("bigint"))
    low, high = F.expr("(_total + 1) div 2"), F.expr("_total div 2 + 1")
    begins = F.col("_upto") - F.col("_n")
    found = []
    while True:
        left = cut_lineage(left)
        upto = F.col("_before") + F.sum(weight).over(Window.partitionBy(*keys).orderBy(value))
        ranked = left.where(F.col("_size") <= small_domain).withColumn("_upto", upto)
        found.append(ranked.where((F.col("_upto") >= low) & (F.col("_upto") - F.col(weight) < high)).select(*keys, F.col(value).alias("_value")))
        large = left.where(F.col("_size") > small_domain)
        if large.isEmpty():
            break
        placed, bins = _histogram(large, keys, value, weight, max(2, ranges))
        bins = cut_lineage(bins.where((F.col("_upto") >= low) & (begins < high)))
        # the two middle ranks lie in neighbouring ranges, or in one; a range of one value needs no more looking
        done = (F.col("_different") == 1) | (F.col("_upto") < high) | (begins >= low)
        near = F.when(F.col("_upto") < high, F.col("_high")).otherwise(F.col("_low"))
        found.append(bins.where(done).select(*keys, near.alias("_value")))
        going_on = bins.where(~done).select(*keys, "_range", begins.alias("_begins"), F.col("_different").alias("_left"))
        met = placed.join(going_on, [*keys, "_range"])
        left = met.select(*keys, value, weight, "_total", F.col("_left").alias("_size"), F.col("_begins").alias("_before"))
    middle = found[0]
    for more in found[1:]:
        middle = middle.unionByName(more)
    return middle.groupBy(*keys).agg(F.avg("_value").alias("median"))
