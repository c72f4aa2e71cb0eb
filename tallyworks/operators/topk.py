"""Top-k rows. Each task keeps k rows and only those are merged."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.operators.counting import value_frequency, word_count
from tallyworks.operators.filters import without_nulls


def top_k(df: DataFrame, value: str, ties: Sequence[str], k: int = 10) -> DataFrame:
    """The k rows with the largest value; equal values are ordered by the ``ties`` columns."""
    rows = without_nulls(df, value, *ties)
    return rows.orderBy(F.desc(value), *[F.asc(t) for t in ties]).limit(k)


def top_k_distinct(df: DataFrame, value: str, ties: Sequence[str], k: int = 10) -> DataFrame:
    """One row for each of the k largest different values: the last one in order of ``ties``.

    The k values are found first from the value column alone, so whole rows are only compared
    for these, and never more than k groups are formed.
    """
    rows = without_nulls(df, value, *ties)
    best = rows.select(value).distinct().orderBy(F.desc(value)).limit(k)
    kept = rows.join(F.broadcast(best), value, "left_semi")  # k rows at most
    whole = F.struct(*[F.col(c) for c in df.columns])
    last = kept.groupBy(value).agg(F.max_by(whole, F.struct(*ties)).alias("_row"))
    return last.select("_row.*").orderBy(F.desc(value))


def top_words(df: DataFrame, text, k: int = 10) -> DataFrame:
    return top_k(word_count(df, text), "n", ["word"], k)


def top_frequencies(df: DataFrame, columns: Sequence[str], k: int = 10, *, value: str = "number") -> DataFrame:
    return top_k(value_frequency(df, columns, value=value), "n", [value], k)
