"""Gaps between successive occurrences of a key, and their statistics.

Rounds are put in order by range over (key, round), so a key with many rounds lies in many tasks. A task looks back within its
own range; for its first row, the last row of the range before is carried over, from a table of one row per range.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tallyworks.operators.medians import exact_medians
from tallyworks.session import broadcast_if_small, cut_lineage

#: Largest number of rows a single generator call makes.
CHUNK = 1_000_000


def _seen(df: DataFrame, key: str, order: str) -> DataFrame:
    """Occurrences per key and round. Written once, since several parts of the result start here."""
    rounds = df.select(F.col(key), F.col(order).cast("bigint").alias(order)).dropna()
    return cut_lineage(rounds.groupBy(key, order).agg(F.count("*").alias("_n")))


def in_ranges(df: DataFrame, columns: list[str], rows: int | None = None) -> DataFrame:
    """Rows dealt out by range and in order within it, about ``rows`` to a range, or as many ranges as shuffles have partitions."""
    ranges = [] if rows is None else [max(1, -(-df.count() // rows))]
    return df.repartitionByRange(*ranges, *columns).sortWithinPartitions(*columns)


def _looked_back(seen: DataFrame, key: str, order: str, rows: int | None) -> DataFrame:
    """Every round with the one before it in its range (``_before``, null for the first row) and the range (``_range``).

    The first round of a key looks back to 0. Written once: a range may be drawn otherwise when it is asked for again.
    """
    schema = StructType([*seen.schema, StructField("_range", IntegerType()), StructField("_before", LongType())])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, last = TaskContext.get().partitionId(), None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, rounds = batch.column(batch.schema.get_field_index(key)), batch.column(batch.schema.get_field_index(order))
            if last is None:
                first = pa.scalar(None, pa.int64())
            else:
                first = last[1] if last[0] == keys[0] else pa.scalar(0, pa.int64())
            earlier = pc.if_else(pc.equal(keys[1:], keys[:-1]), rounds[:-1], pa.scalar(0, pa.int64()))
            before = pa.concat_arrays([pa.array([first.as_py()], pa.int64()), earlier])
            last = keys[-1], rounds[-1]
            columns = [*batch.columns, pa.array([number] * batch.num_rows, pa.int32()), before]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "_range", "_before"])

    return cut_lineage(in_ranges(seen, [key, order], rows).mapInArrow(look, schema))


def _first_gaps(seen: DataFrame, key: str, order: str, rows: int | None) -> DataFrame:
    """Gap of the first occurrence in every round of a key."""
    looked = _looked_back(seen, key, order, rows)
    ends = looked.groupBy("_range").agg(F.max(F.struct(key, order)).alias("_last"))
    carried = ends.select("_range", F.lag("_last").over(Window.orderBy("_range")).alias("_carried"))
    met = looked.join(broadcast_if_small(carried), "_range")
    crossing = F.when(F.col(f"_carried.{key}") == F.col(key), F.col(f"_carried.{order}")).otherwise(F.lit(0))
    return met.select(key, order, (F.col(order) - F.coalesce("_before", crossing)).alias("gap"))


def _repeats(seen: DataFrame, key: str, order: str) -> DataFrame:
    """Further occurrences in a round, which have gap 0, with their number."""
    zero = F.lit(0).cast("bigint").alias("gap")
    return seen.filter(F.col("_n") > 1).select(key, order, zero, (F.col("_n") - 1).alias("n"))


def gap_counts(df: DataFrame, key: str, order: str, *, stretch: int | None = None) -> DataFrame:
    """Gaps of the occurrences of a key with their number; ``order`` is an integer column.

    ``stretch`` is how many rounds a range should hold; by default a shuffle's partitions are filled.
    """
    seen = _seen(df, key, order)
    first = _first_gaps(seen, key, order, stretch).withColumn("n", F.lit(1).cast("bigint"))
    return first.unionByName(_repeats(seen, key, order))


def gaps(df: DataFrame, key: str, order: str, *, stretch: int | None = None, chunk: int = CHUNK) -> DataFrame:
    """One row per occurrence with its gap. Large repeats are made in chunks over several tasks."""
    seen = _seen(df, key, order)
    repeats = _repeats(seen, key, order)
    size = F.lit(chunk).cast("bigint")

    def made(rows: DataFrame, n: str) -> DataFrame:
        each = rows.select(key, order, "gap", F.explode(F.sequence(F.lit(1), F.col(n).cast("int"))).alias("_i"))
        return each.drop("_i")

    chunks = (
        repeats.filter(F.col("n") > chunk)
        .withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(n - 1) div {chunk}"))))
        .withColumn("_m", F.least(size, F.col("n") - F.col("_chunk") * size))
        .repartition(key, order, "_chunk")
    )
    return (
        _first_gaps(seen, key, order, stretch)
        .unionByName(made(repeats.filter(F.col("n") <= chunk), "n"))
        .unionByName(made(chunks, "_m"))
    )


def gap_stats(df: DataFrame, key: str, order: str, *, stretch: int | None = None) -> DataFrame:
    """Number, mean, sample deviation and median of the gaps of a key, and its last round.

    Everything follows from the number of occurrences of each gap of a key. That table is written
    once, since the median looks at it more than once.
    """
    counted = gap_counts(df, key, order, stretch=stretch)
    weighted = cut_lineage(counted.groupBy(key, "gap").agg(F.sum("n").alias("weight"), F.max(order).alias("_last")))
    gap, n = F.col("gap").cast("double"), F.col("n")
    sums = weighted.groupBy(key).agg(
        F.sum("weight").alias("n"),
        F.sum(gap * F.col("weight")).alias("_s1"),
        F.sum(gap * gap * F.col("weight")).alias("_s2"),
        F.max("_last").alias("last"),
    )
    variance = (F.col("_s2") - F.col("_s1") * F.col("_s1") / n) / (n - 1)
    stats = sums.select(
        key,
        "n",
        (F.col("_s1") / n).alias("average"),
        F.when(n > 1, F.sqrt(F.greatest(variance, F.lit(0.0)))).alias("stddev"),
        "last",
    )
    return stats.join(exact_medians(weighted, [key], "gap", "weight"), key)
