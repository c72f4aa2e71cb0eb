"""Grouped summaries built on partial aggregation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.classify import PAY_LEVELS, coded
from tallyworks.functions.text import letter_tokens
from tallyworks.operators.counting import without_words
from tallyworks.operators.filters import without_nulls
from tallyworks.operators.medians import exact_medians
from tallyworks.session import cut_lineage


def min_max_count(df: DataFrame, key: str, moment: str) -> DataFrame:
    """First and last moment and row count per key; rows lacking either are left out."""
    rows = without_nulls(df.select(key, moment)).groupBy(key)
    return rows.agg(F.min(moment).alias("first"), F.max(moment).alias("last"), F.count("*").alias("n"))


def min_max_and_words(
    df: DataFrame, key: str, moment: str, text: str | Column, stop_df: DataFrame, stop_text
) -> tuple[DataFrame, DataFrame]:
    """Two results of one scan: ``min_max_count`` and the word count without stopwords.

    Each row becomes an entry for its key and one for each of its words, and one aggregate, partial in every task,
    counts both kinds. What is written to be shared is as small as the two results.
    """
    words = F.coalesce(letter_tokens(text), F.array().cast("array<string>"))
    moments = df.select(F.col(key).alias("key"), F.col(moment).alias("moment"), words.alias("words"))
    nothing = {name: F.lit(None).cast(kind).alias(name) for name, kind in moments.drop("words").dtypes}
    entries = F.concat(
        F.array(F.struct("key", "moment", F.lit(None).cast("string").alias("word"))),
        F.transform("words", lambda w: F.struct(nothing["key"], nothing["moment"], w.alias("word"))),
    )
    kinds = moments.select(F.explode(entries).alias("of")).select("of.*").filter("word is not null or key is not null and moment is not null")
    totals = kinds.groupBy("key", "word").agg(F.min("moment").alias("first"), F.max("moment").alias("last"), F.count("*").alias("n"))
    totals = cut_lineage(totals)
    spans = totals.filter("word is null").select(F.col("key").alias(key), "first", "last", "n")
    return spans, without_words(totals.filter("word is not null").select("word", "n"), stop_df, stop_text)


def average_by(df: DataFrame, group: Column, measure: Column, *, name: str) -> DataFrame:
    """Count and mean of a measure per group."""
    rows = without_nulls(df.select(group.alias(name), measure.alias("measure")))
    return rows.groupBy(name).agg(F.count("*").alias("n"), F.avg("measure").alias("average"))


def averages_by(
    df: DataFrame,
    key: str,
    measures: Sequence[str],
    category: str,
    codes: Mapping[str, float] = PAY_LEVELS,
) -> DataFrame:
    """Count and several means per key, one of them over a coded category."""
    rows = without_nulls(df.select(key, *measures, category))
    return rows.groupBy(key).agg(
        F.count("*").alias("n"),
        *[F.avg(m).alias(f"avg_{m}") for m in measures],
        F.avg(coded(category, codes)).alias(f"avg_{category}"),
    )


def median_and_deviation(df: DataFrame, group: Column, measure: Column, *, name: str) -> DataFrame:
    """Exact median and sample standard deviation per group."""
    rows = without_nulls(df.select(group.alias(name), measure.alias("measure")))
    spread = rows.groupBy(name).agg(
        F.count("*").alias("n"), F.stddev_samp("measure").alias("stddev")
    )
    weighted = rows.groupBy(name, "measure").agg(F.count("*").alias("weight"))
    return spread.join(exact_medians(weighted, [name], "measure", "weight", rows=rows), name)
