"""Equi-joins. Rows without a key take no part in any of them.

Adaptive execution splits an oversized partition of an inner join on either side, but of an outer
join only on the side that is kept whole, and of a full join on none. Outer joins therefore count the
keys first. Rows under the few hot ones go through an inner join, and the counts tell which of them have
no partner at all; the rest is Spark's own outer join. So every row is shuffled once, and a key that holds much
of a table stays splittable.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.classify import STATE_CODES, place_class
from tallyworks.operators.counting import word_count
from tallyworks.operators.filters import without_nulls
from tallyworks.session import broadcast_if_small, cut_lineage

#: Rows of one side under one key from which on the key is joined by itself.
HOT_ROWS = 1_000_000

HOW = ("inner", "left", "right", "full", "anti")


def _apart(left: DataFrame, right: DataFrame, right_key: str) -> tuple[DataFrame, str]:
    """The right side with ``_right`` behind the names that both sides have, and its key."""
    taken = {c.lower() for c in left.columns}
    names = {c: f"{c}_right" for c in right.columns if c.lower() in taken}
    return right.withColumnsRenamed(names), names.get(right_key, right_key)


def _hot_keys(left: DataFrame, left_key: str, right: DataFrame, right_key: str, hot_rows: int) -> DataFrame:
    """Keys with ``hot_rows`` or more on a side, with the rows of either side; at most one for so many rows of the input."""
    sides = left.select(F.col(left_key).alias("_key"), F.lit(1).alias("_left"), F.lit(0).alias("_right"))
    sides = sides.union(right.select(F.col(right_key).alias("_key"), F.lit(0), F.lit(1)))
    counts = sides.groupBy("_key").agg(F.sum("_left").alias("_left"), F.sum("_right").alias("_right"))
    return cut_lineage(counts.filter(F.greatest("_left", "_right") >= hot_rows))


def _cold_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str) -> DataFrame:
    joined = left.join(right, F.col(left_key) == F.col(right_key), "full" if how == "anti" else how)
    return joined.filter(F.col(left_key).isNull() | F.col(right_key).isNull()) if how == "anti" else joined


def _hot_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str, hot: DataFrame) -> DataFrame:
    hot = broadcast_if_small(hot)
    own, other = left.join(hot, F.col(left_key) == F.col("_key")), right.join(hot, F.col(right_key) == F.col("_key"))
    counts = ("_key", "_left", "_right")
    parts = []
    if how != "anti":
        parts.append(own.drop(*counts).join(other.drop(*counts), F.col(left_key) == F.col(right_key)))
    if how in ("left", "full", "anti"):
        parts.append(own.filter("_right = 0").drop(*counts))
    if how in ("right", "full", "anti"):
        parts.append(other.filter("_left = 0").drop(*counts))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part, allowMissingColumns=True)
    return result


def keyed_join(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "inner", *, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Join on one key of each side; columns of the right side whose name is taken end in ``_right``.

    ``anti`` keeps the rows of *either* side that have no partner. Columns of a side that is
    absent from a row are null. ``hot_rows`` changes how outer joins are made, not what they return.
    """
    if how not in HOW:
        raise ValueError(f"how must be one of {HOW}")
    right, right_key = _apart(left, right, right_key)
    left, right = without_nulls(left, left_key), without_nulls(right, right_key)
    if how == "inner":
        return left.join(right, F.col(left_key) == F.col(right_key))
    hot = _hot_keys(left, left_key, right, right_key, hot_rows)
    if hot.isEmpty():
        return _cold_join(left, right, left_key, right_key, how)
    known = broadcast_if_small(hot.select("_key"))
    cold_left = left.join(known, F.col(left_key) == F.col("_key"), "left_anti")
    cold_right = right.join(known, F.col(right_key) == F.col("_key"), "left_anti")
    cold = _cold_join(cold_left, cold_right, left_key, right_key, how)
    return cold.unionByName(_hot_join(left, right, left_key, right_key, how, hot), allowMissingColumns=True)


def one_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The last row of every key in the stated order."""
    whole = F.struct(*[F.col(c) for c in df.columns])
    last = without_nulls(df, key).groupBy(key).agg(F.max_by(whole, F.struct(*order)).alias("_row"))
    return last.select("_row.*")


def replicated_join(
    rows: DataFrame,
    small: DataFrame,
    row_key: str,
    small_key: str,
    how: str = "inner",
    *,
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Join against a small table with unique keys, copied to every executor.

    The small side is measured first. One that is too large is shuffled instead, with the rows as
    the side that is kept whole, so that a hot key among them can be split. ``order`` states which
    of several rows of a key in the small table counts.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    small = without_nulls(small, small_key)
    if order is not None:
        small = cut_lineage(one_per_key(small, small_key, order))  # measured, and then joined
    small, small_key = _apart(rows, small, small_key)
    rows = without_nulls(rows, row_key)
    return rows.join(broadcast_if_small(small), F.col(row_key) == F.col(small_key), how)


def with_place_class(
    people: DataFrame,
    person_key: str,
    place: str,
    texts: DataFrame,
    text_key: str,
    codes: Sequence[str] = STATE_CODES,
) -> DataFrame:
    """Texts with the class of their author's place."""
    classed = people.select(person_key, place_class(place, codes).alias("state"))
    return keyed_join(texts, classed, text_key, person_key, "inner")


def word_count_by_place(
    people: DataFrame,
    person_key: str,
    place: str,
    texts: DataFrame,
    text_key: str,
    text: str,
    codes: Sequence[str] = STATE_CODES,
) -> DataFrame:
    """Occurrences of every word per class of the author's place."""
    joined = with_place_class(people, person_key, place, texts, text_key, codes)
    return word_count(joined, text, keep=["state"])
