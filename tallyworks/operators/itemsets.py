"""Frequent items and itemsets of baskets."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.session import broadcast_if_small, cut_lineage


def frequent_items(df: DataFrame, basket: str, item: str, min_support: int) -> DataFrame:
    """Items that occur in at least ``min_support`` baskets, with that number."""
    pairs = df.select(basket, item).dropna().distinct()
    counts = pairs.groupBy(item).agg(F.count("*").alias("support"))
    return counts.filter(F.col("support") >= min_support)


def frequent_baskets(df: DataFrame, basket: str, item: str, min_support: int) -> DataFrame:
    """Baskets cut down to their frequent items, sorted and each once.

    The frequent items are found first. They are sent to the rows when they are few, which keeps
    the rows from being shuffled by item, where a common item would fill one partition. A basket
    can hold no more items than there are frequent ones, however often it occurs, and its repeats
    are dropped before the shuffle.
    """
    kept = cut_lineage(frequent_items(df, basket, item, min_support).select(item))
    rows = df.select(basket, item).dropna(subset=[basket]).join(broadcast_if_small(kept), item, "left_semi")
    return rows.groupBy(basket).agg(F.sort_array(F.collect_set(item)).alias("items"))


def _longer_in(sets: DataFrame, basket: str) -> DataFrame:
    """Sets of one item more in the same basket: each item behind the last of a set is added to it, in the order of the basket.

    ``rest`` holds the items behind the last one, so a set is found once, and without looking at other rows.
    """
    each = sets.select(basket, "items", "rest", F.posexplode("rest").alias("_at", "_next"))
    return each.select(basket, F.array_append("items", F.col("_next")).alias("items"), F.slice("rest", F.col("_at") + 2, F.size("rest")).alias("rest"))


def _extended(frequent: DataFrame, size: int) -> DataFrame:
    """Sets of one item more, from two sets of ``size`` that differ in the last item only."""
    head, last = F.slice("items", 1, size - 1).alias("_head"), F.element_at("items", -1)
    left = frequent.select(head, F.col("items").alias("_items"), last.alias("_last"))
    right = frequent.select(head, last.alias("_next"))
    met = left.join(right, "_head").where(F.col("_last") < F.col("_next"))
    return met.select(F.array_append("_items", F.col("_next")).alias("items"))


def _candidates(frequent: DataFrame, size: int) -> DataFrame:
    """Sets of one item more than the frequent ones of ``size``, all of whose parts of that size are frequent."""
    longer = _extended(frequent, size)
    # the parts without the last or the last but one item are the two that were put together
    others = [F.concat(F.slice("items", 1, i), F.slice("items", i + 2, size - i)) for i in range(size - 1)]
    parts = longer.select("items", F.explode(F.array(*others)).alias("_part"))
    known = parts.join(frequent.select(F.col("items").alias("_part")), "_part", "left_semi")
    return known.groupBy("items").agg(F.count("*").alias("_n")).where(F.col("_n") == size - 1).select("items")


def itemsets_up_to(baskets: DataFrame, basket: str, min_support: int, most: int) -> list[DataFrame]:
    """Frequent sets of 1, 2, ... ``most`` items with their support, one table per size, until a size has none.

    ``baskets`` holds every basket once with its sorted items, each of them frequent. Candidates of the next size are joined from
    frequent sets that share all but their last item; one with a part that is not frequent is dropped before anything is counted.
    The sets of a basket are made longer item by item, only as far as they are candidates, so nothing but counts is shuffled,
    and nothing larger than ``most`` is looked for.
    """

    def counted(found: DataFrame) -> DataFrame:
        counts = found.groupBy("items").agg(F.count("*").alias("support"))
        return counts.where(F.col("support") >= min_support)

    empty = F.slice("items", 1, 0)
    rows = _longer_in(baskets.select(basket, empty.alias("items"), F.col("items").alias("rest")), basket)
    levels = [counted(rows)]
    while len(levels) < most:
        size = len(levels)
        rows = _longer_in(rows, basket)
        if size > 1:  # any two items are a candidate
            levels[-1] = cut_lineage(levels[-1])
            likely = cut_lineage(_candidates(levels[-1], size))
            if likely.isEmpty():
                break
            rows = rows.join(broadcast_if_small(likely), "items", "left_semi")
            if size > 2:
                rows = cut_lineage(rows)
        levels.append(counted(rows))
    return levels


def frequent_itemsets(
    df: DataFrame,
    basket: str,
    item: str,
    min_support: int,
    *,
    sizes: Sequence[int] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Sets of items found together in at least ``min_support`` baskets, with their size as level.

    For stated ``sizes`` sets are found size by size up to the largest of them. Without a bound, mining is Spark's own
    parallel FP-growth over baskets of frequent items, which prunes by itself and needs no pass per
    level. The baskets are written once, since both read them more than once.
    """
    baskets = cut_lineage(frequent_baskets(df, basket, item, min_support))
    if sizes is not None:
        levels = itemsets_up_to(baskets, basket, min_support, max([*sizes, 0]))
        found = [level.select("items", "support", F.lit(n).alias("level")) for n, level in enumerate(levels, 1)]
        return reduce(DataFrame.unionByName, found).filter(F.col("level").isin(*sizes))
    count = baskets.count()
    # FP-growth rounds share * baskets up: half a basket less gives the number asked for
    share = (min_support - 0.5) / count if count else 1.0
    if share >= 1.0:
        empty = baskets.filter(F.lit(False))
        return empty.select("items", F.lit(0).cast("bigint").alias("support"), F.lit(0).alias("level"))
    options = {"numPartitions": partitions} if partitions else {}
    model = FPGrowth(itemsCol="items", minSupport=share, minConfidence=1.0, **options).fit(baskets)
    return model.freqItemsets.select(
        F.sort_array("items").alias("items"), F.col("freq").alias("support"), F.size("items").alias("level")
    )
