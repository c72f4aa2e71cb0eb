"""Children gathered under their parents, in records of bounded size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, MapType, StringType, StructType, VariantType
from pyspark.sql.window import Window

from tallyworks.operators.filters import without_nulls
from tallyworks.operators.joins import one_per_key
from tallyworks.session import broadcast_if_small, cut_lineage

#: Items, and bytes of items, that a record holds at most.
PART_ITEMS = 100_000
PART_BYTES = 64 * 1024 * 1024
#: Items, and bytes of items, of a key that are held at once, to be cut into records of fewer.
HELD_ITEMS = 100_000
HELD_BYTES = 64 * 1024 * 1024
#: Bytes that a value takes besides its text.
VALUE_BYTES = 8


def _size_of(value: Column, kind: DataType) -> Column | int:
    """Bytes of a value; a number where all values of the type are alike."""
    if isinstance(kind, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)).cast("bigint") + VALUE_BYTES
    if isinstance(kind, StructType):
        return reduce(lambda a, b: a + b, [_size_of(value[f.name], f.dataType) for f in kind], VALUE_BYTES)
    if isinstance(kind, (ArrayType, MapType, VariantType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(value))), F.lit(0)).cast("bigint") + VALUE_BYTES
    return VALUE_BYTES


def _gathered(
    df: DataFrame, keys: Sequence[str], item: Column, out: str, part_items: int, part_bytes: int
) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """Records of the keys whose items are held at once, of the others, and the keys of those; the latter two are None without any.

    Those of the former are all in one record, or cut into several where items cost the same.
    """
    rows = without_nulls(df.select(*keys, item.alias("_item")), *keys)
    size = _size_of(F.col("_item"), rows.schema["_item"].dataType)
    # an item costs its bytes, but not less than its share of a record of so many items
    least = -(-part_bytes // part_items)
    whole = least * part_items
    fixed = isinstance(size, int)
    cost = F.lit(max(least, size)).cast("bigint") if fixed else F.greatest(F.lit(least).cast("bigint"), size)
    costs = (without_nulls(df.select(*keys), *keys) if fixed else rows).select(*keys, cost.alias("_cost"))
    held = max(whole, max(least, size) * min(HELD_ITEMS, HELD_BYTES // size)) if fixed else whole
    large = costs.groupBy(*keys).agg(F.sum("_cost").alias("_all")).filter(F.col("_all") > held).select(*keys)
    columns = [*keys, "part", out]

    def collected(group: DataFrame) -> DataFrame:
        records = group.groupBy(*keys).agg(F.sort_array(F.collect_list("_item")).alias(out))
        if held == whole:
            return records.withColumn("part", F.lit(0)).select(columns)
        each = max(least, size)
        first = lambda part: f"((cast({part} as bigint) * {whole} + {each - 1}) div {each})"
        parts = F.expr(f"transform(sequence(0, cast((size(`{out}`) - 1L) * {each} div {whole} as int)), p -> struct(p as col1, slice(`{out}`, cast({first('p')} as int) + 1, cast({first('(p + 1)')} - {first('p')} as int)) as col2))")
        cut = records.select(*keys, F.explode(parts).alias("_record")).where(F.size("_record.col2") > 0)
        return cut.select(*keys, F.col("_record.col1").alias("part"), F.col("_record.col2").alias(out))

    if large.isEmpty():
        return collected(rows), None, None

    large = cut_lineage(large)
    known = broadcast_if_small(large)
    copies = rows.join(known, list(keys), "left_semi").groupBy(*keys, "_item").agg(F.count("*").alias("_copies")).withColumn("_cost", cost)
    # written, for a range may be drawn otherwise when it is asked for again
    ranged = cut_lineage(copies.repartitionByRange(*keys, "_item").withColumn("_range", F.spark_partition_id()))
    run = F.col("_cost") * F.col("_copies")
    in_range = Window.partitionBy(*keys, "_range").orderBy("_item")
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy(*keys, "_range").agg(F.sum(run).alias("_sum"))
    offsets = offsets.select(*keys, "_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    placed = ranged.withColumn("_start", F.sum(run).over(in_range) - run).join(offsets, [*keys, "_range"])
    placed = placed.withColumn("_start", F.col("_start") + F.col("_offset"))
    parts = F.sequence(F.expr(f"_start div {whole}"), F.expr(f"(_start + _cost * (_copies - 1)) div {whole}"))
    lots = placed.withColumn("_part", F.explode(parts))

    def copies_before(part: str) -> Column:
        """How many copies begin before a part."""
        return F.greatest(F.lit(0), F.least(F.col("_copies"), F.expr(f"({part} * {whole} - _start + _cost - 1) div _cost")))

    runs = F.array_repeat(F.col("_item"), (copies_before("(_part + 1)") - copies_before("_part")).cast("int"))
    taken = lots.select(*keys, "_part", runs.alias("_runs")).where(F.size("_runs") > 0)
    dealt = taken.groupBy(*keys, "_part").agg(F.sort_array(F.flatten(F.collect_list("_runs"))).alias(out))
    return collected(rows.join(known, list(keys), "left_anti")), dealt.withColumn("part", F.col("_part").cast("int")).select(columns), large


def gather(
    df: DataFrame, keys: Sequence[str], item: Column, *, out: str, part_items: int = PART_ITEMS, part_bytes: int = PART_BYTES
) -> DataFrame:
    """Sorted array ``out`` of the items of every key, with a ``part`` number.

    Items are taken in order within their key. Each costs its bytes, but at least ``part_bytes / part_items``, and lies in the
    part in which the costs before it end. So a part holds at most ``part_items`` items, and ``part_bytes`` with the last
    item left out; joined, the parts give the sorted items. Small items fill all parts but the last. Part numbers ascend, and only
    behind an item larger than a part one may be left out. A key that fits one part has the part 0.

    Keys with more are found by a sum over the keys, or over the lengths of their items; without any, the work is one plain
    grouping. So it is where items cost the same and those of a key can be held at once, up to ``HELD_ITEMS`` and ``HELD_BYTES``: they
    are cut where they lie. The items of other keys are dealt by range, summed up within their range and moved up by the sums of
    the ranges before, so no task ever holds all items of such a key.
    """
    small, dealt, _ = _gathered(df, keys, item, out, part_items, part_bytes)
    return small if dealt is None else small.unionByName(dealt)


def nest(
    parents: DataFrame,
    children: DataFrame,
    parent_key: str,
    child_key: str,
    child_columns: Sequence[str],
    *,
    keep_childless: bool = True,
    order: Sequence[str] | None = None,
    out: str = "children",
    part_items: int = PART_ITEMS,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """Parents with the array of their children; children without a parent are dropped.

    Parents must be unique by key, unless ``order`` states which of several counts: the last. A parent with more children than
    a record holds (see ``gather``) takes several records, numbered by ``part``. Children are gathered first, by the key
    the parents are joined on, and a parent meets whole records, not each child. Those of the large parents are joined by
    themselves, in an inner join, where the records of one can be split over tasks.
    """
    rows = one_per_key(parents, parent_key, order) if order is not None else without_nulls(parents, parent_key)
    items = children.select(F.col(child_key).alias("_parent"), F.struct(*[F.col(c) for c in child_columns]).alias("_child"))
    small, dealt, large = _gathered(items, ["_parent"], F.col("_child"), out, part_items, part_bytes)
    columns = [*[F.col(c) for c in rows.columns], F.coalesce("part", F.lit(0)).alias("part")]
    children_of = F.coalesce(out, F.array().cast(small.schema[out].dataType)).alias(out)

    def joined(some: DataFrame, records: DataFrame, how: str) -> DataFrame:
        return some.join(records, F.col(parent_key) == F.col("_parent"), how).select(*columns, children_of)

    how = "left" if keep_childless else "inner"
    if dealt is None:
        return joined(rows, small, how)
    known = broadcast_if_small(large.withColumnRenamed("_parent", "_large"))
    is_large = F.col(parent_key) == F.col("_large")
    few, others = rows.join(known, is_large, "left_semi"), rows.join(known, is_large, "left_anti")
    return joined(others, small, how).unionByName(joined(few, dealt, "inner"))


def nest_by_role(
    df: DataFrame,
    is_parent: Column,
    own_key: str,
    parent_ref: str,
    child_columns: Sequence[str],
    **options,
) -> DataFrame:
    """Nesting of one table in itself: rows of the parent role keep the others below them."""
    parents = df.filter(is_parent)
    children = df.filter(~F.coalesce(is_parent, F.lit(False)))
    return nest(parents, children, own_key, parent_ref, child_columns, **options)
