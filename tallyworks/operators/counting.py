"""Counts and frequencies. Every one is a grouped count with map-side partial aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.classify import STATE_CODES, place_class
from tallyworks.functions.text import LISTED_WORDS, STOPWORDS, explode_words, stopword_tokens


def count_by(df: DataFrame, *keys, n: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(n))


def word_count(df: DataFrame, text, *, keep: Sequence[str] = (), **options) -> DataFrame:
    """Occurrences of every word, per combination of the ``keep`` columns."""
    return count_by(explode_words(df, text, keep=keep, **options), *keep, "word")


def word_count_split(df: DataFrame, text, stopwords: Sequence[str] = STOPWORDS) -> DataFrame:
    """Word count with a flag telling the words of ``stopwords`` from the kept ones."""
    counts = word_count(df, text, lower_again=True)
    return counts.withColumn("is_stopword", F.col("word").isin(*stopwords))


def listed_word_count(df: DataFrame, text, words: Sequence[str] = LISTED_WORDS) -> DataFrame:
    """Occurrences of the listed words only; others are dropped before the shuffle."""
    listed = explode_words(df, text, lower_again=True).filter(F.col("word").isin(*words))
    return count_by(listed, "word")


def word_count_without(df: DataFrame, text, stop_df: DataFrame, stop_text) -> DataFrame:
    """Word count less every word that occurs in the stopword texts.

    The anti join runs on the counts, which are already partitioned by word.
    """
    return without_words(word_count(df, text), stop_df, stop_text)


def without_words(counts: DataFrame, stop_df: DataFrame, stop_text) -> DataFrame:
    """Counts of words less every word that occurs in the stopword texts."""
    return counts.join(stopword_tokens(stop_df, stop_text), "word", "left_anti")


def distinct_values(df: DataFrame, column, *, sort: bool = False) -> DataFrame:
    values = df.select(column).dropna().distinct()
    return values.orderBy(*values.columns) if sort else values


def distinct_count(df: DataFrame, column, *, n: str = "n") -> DataFrame:
    """Number of different values: partly de-duplicated per task, then counted."""
    return df.agg(F.count_distinct(column).alias(n))


def _melt(df: DataFrame, columns: Sequence[str], position: str, value: str) -> DataFrame:
    """One row per listed column; rows with a gap in any of them are left out."""
    whole = df.select(*columns).dropna()
    return whole.unpivot([], list(columns), position, value)


def value_frequency(df: DataFrame, columns: Sequence[str], *, value: str = "number") -> DataFrame:
    """Frequency of a value over several columns."""
    return count_by(_melt(df, columns, "position", value), value)


def position_frequency(
    df: DataFrame, columns: Sequence[str], *, position: str = "position", value: str = "number"
) -> DataFrame:
    """Frequency of a value within each of several columns."""
    return count_by(_melt(df, columns, position, value), position, value)


def relative_frequency(df: DataFrame, columns: Sequence[str], *, value: str = "number") -> DataFrame:
    """Frequency and its share of the grand total.

    The total is a scalar subquery over the counts, so no window has to see all of them.
    """
    counts = value_frequency(df, columns, value=value)
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", F.col("n") / total)


def class_count(df: DataFrame, place: str | Column, codes: Sequence[str] = STATE_CODES) -> DataFrame:
    """Rows per class of place."""
    return count_by(df.select(place_class(place, codes).alias("state")), "state")
