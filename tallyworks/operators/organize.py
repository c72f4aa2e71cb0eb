"""Anonymizing, shuffling and binning of rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tallyworks.functions.moments import day_text
from tallyworks.functions.text import tag_list
from tallyworks.operators.counting import distinct_values
from tallyworks.operators.filters import contains_text
from tallyworks.session import cut_lineage


def shuffle_rows(df: DataFrame, partitions: int | None = None, seed: int = 0) -> DataFrame:
    """The same rows in another order, spread evenly over partitions.

    Rows are dealt out in turn, so copies of one row do not meet in one task, and the order within
    a partition is that of a seeded hash. Both come out the same when a lost task is run again,
    which a random key does not promise.
    """
    dealt = df.repartition(partitions) if partitions else df.hint("rebalance")
    return dealt.sortWithinPartitions(F.xxhash64(F.lit(seed), *[F.col(c) for c in df.columns]))


def anonymize(df: DataFrame, ids: Sequence[str], moment: str, partitions: int | None = None, seed: int = 0) -> DataFrame:
    """Rows without their ids, with the day instead of the moment, in another order."""
    return shuffle_rows(without_ids(df, ids, moment), partitions, seed)


def without_ids(df: DataFrame, ids: Sequence[str], moment: str) -> DataFrame:
    """Rows without their ids, with the day instead of the moment."""
    is_text = isinstance(df.schema[moment].dataType, StringType)
    return df.drop(*ids).withColumn(moment, day_text(moment) if is_text else F.to_date(moment))


def anonymize_and_distinct(
    df: DataFrame, ids: Sequence[str], moment: str, key: str, partitions: int | None = None, seed: int = 0
) -> tuple[DataFrame, DataFrame]:
    """Two results of one scan: the anonymized rows and the different values of a key.

    The rows are written once where they are dealt out anew, and both results are read from there.
    """
    dealt = cut_lineage(shuffle_rows(df, partitions, seed))
    return without_ids(dealt, ids, moment), distinct_values(dealt, key)


def tag_bins(tags: Column | str, body: Column | str, tag_names: Mapping[str, str], body_part: str, body_bin: str) -> Column:
    """Bins of a post: one per listed tag, one when the body contains a word.

    A post without tags has no bins at all.
    """
    text = F.col(tags) if isinstance(tags, str) else tags
    found = tag_list(text)
    named = [F.when(F.array_contains(found, tag), F.lit(name)) for tag, name in tag_names.items()]
    in_body = F.when(contains_text(body, body_part), F.lit(body_bin))
    return F.when(text.isNotNull(), F.array_compact(F.array(*named, in_body)))


def to_bins(df: DataFrame, bins: Column, *, name: str = "bin") -> DataFrame:
    """One row per row and bin; rows without a bin are left out."""
    return df.withColumn(name, F.explode(F.array_distinct(bins)))


def year_bins(df: DataFrame, moment: str, *, name: str = "year") -> DataFrame:
    """Rows with the year of their moment; rows without one are left out."""
    return df.filter(F.col(moment).isNotNull()).withColumn(name, F.year(moment))
