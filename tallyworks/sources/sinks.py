"""Writers. All overwrite their target."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_pairs(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Text lines of tab-separated columns, a null as empty text."""
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    df.select(F.concat_ws("\t", *texts).alias("value")).write.mode("overwrite").text(path)


def write_lines(df: DataFrame, path: str, line) -> None:
    df.select(line.alias("value")).write.mode("overwrite").text(path)


def write_bins(df: DataFrame, path: str, bin_column: str, *, file_format: str = "parquet") -> None:
    """One folder per bin.

    Rows are rebalanced by bin first: small bins end in one file and a large one is split over
    several tasks.
    """
    rows = df.hint("rebalance", bin_column)
    rows.write.mode("overwrite").partitionBy(bin_column).format(file_format).save(path)


def write_counted(df: DataFrame, path: str, counters: Mapping[str, Column], *, bin_column: str | None = None, file_format: str = "parquet") -> dict[str, int]:
    """Write rows, in bins if a column is named, and return how many meet each of the conditions.

    The counters are metrics of the write itself: the rows are computed and read once.
    """
    seen = Observation()
    rows = df.observe(seen, *[F.count_if(condition).alias(name) for name, condition in counters.items()])
    if bin_column is None:
        rows.write.mode("overwrite").format(file_format).save(path)
    else:
        write_bins(rows, path, bin_column, file_format=file_format)
    return dict(seen.get)


def write_together(results: Mapping[str, DataFrame], path: str) -> None:
    """Several results in one write job, so that all are there or none; ``read_together`` reads one by its name.

    Columns of one name must have one type in all results.
    """
    tagged = [df.withColumn("_result", F.lit(name)) for name, df in results.items()]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    rows.write.mode("overwrite").partitionBy("_result").parquet(path)


def read_together(spark: SparkSession, path: str, name: str, columns: Sequence[str]) -> DataFrame:
    """The rows of one result of ``write_together``."""
    return spark.read.parquet(path).where(F.col("_result") == name).select(*columns)


def write_named(results: Mapping[str, DataFrame], path: str, *, file_format: str = "parquet") -> None:
    """Several results below one folder, each under its name."""
    for name, df in results.items():
        df.write.mode("overwrite").format(file_format).save(f"{path.rstrip('/')}/{name}")
