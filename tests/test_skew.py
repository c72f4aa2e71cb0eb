"""One key holds a third of all rows: results stay whole and the work stays spread."""

import pytest
from pyspark.sql import functions as F

from tallyworks.operators import gaps, joins, medians, nesting

ROWS = 60_000


@pytest.fixture
def skewed(spark):
    """Rows of which a third share key 0; small limits make adaptive execution act on them."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    rows = spark.range(0, ROWS, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997 + 1).alias("key"), F.col("id").alias("item")
    )
    yield rows
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.fixture
def parents(spark):
    return spark.range(1200).select(F.col("id").alias("pid"), F.concat(F.lit("p"), "id").alias("name"))


def final_plan(df):
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how, extra", [("inner", 0), ("left", 202), ("right", 0), ("full", 202)])
def test_hot_key_is_split_in_every_join(skewed, parents, how, extra):
    rows, plan = final_plan(joins.keyed_join(parents, skewed, "pid", "key", how, hot_rows=5000))
    assert len(rows) == ROWS + extra
    assert "skew=true" in plan


@pytest.mark.parametrize("how", ["left", "right", "full", "anti"])
def test_outer_joins_are_the_same_with_and_without_hot_keys(skewed, parents, how):
    left = parents.unionByName(parents.where("pid = 1100")).unionByName(parents.where("pid = 5"))
    results = [joins.keyed_join(left, skewed.where("key <> 7"), "pid", "key", how, hot_rows=n) for n in (2, 5000, 10**9)]
    first, *others = [sorted(map(str, r.collect())) for r in results]
    assert all(first == other for other in others) and first
    plan = results[2]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and "Aggregate" not in plan


def test_hot_key_is_split_when_the_small_side_is_too_large(skewed, parents, monkeypatch):
    monkeypatch.setattr(joins, "broadcast_if_small", lambda df: df)
    rows, plan = final_plan(joins.replicated_join(skewed, parents, "key", "pid", "left"))
    assert len(rows) == ROWS and "skew=true" in plan


def test_hot_parent_is_continued(skewed, parents):
    spark = skewed.sparkSession
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else these few bytes are put together
    nested = nesting.nest(parents, skewed, "pid", "key", ["item"], part_items=1000)
    located = nested.withColumn("task", F.spark_partition_id()).select("pid", "part", "task", F.expr("transform(children, c -> c.item)").alias("items"))
    found = located.collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    hot = sorted((r["part"], r["items"], r["task"]) for r in found if r["pid"] == 0)
    assert [p for p, _, _ in hot] == list(range(20)) and {len(i) for _, i, _ in hot} == {1000}
    assert [i for _, items, _ in hot for i in items] == list(range(0, ROWS, 3))
    assert len({t for _, _, t in hot}) > 1
    assert sum(len(r["items"]) for r in found) == ROWS and {r["pid"] for r in found} == set(range(1200))


def test_equal_children_fill_several_parts(spark):
    children = spark.createDataFrame([(1, "a")] * 7 + [(1, "b")] + [(2, "c")], "k int, v string")
    parents = spark.createDataFrame([(1,), (2,), (3,)], "p int")
    nested = nesting.nest(parents, children, "p", "k", ["v"], part_items=3)
    parts = sorted((r.p, r.part, "".join(c.v for c in r.children)) for r in nested.collect())
    assert parts == [(1, 0, "aaa"), (1, 1, "aaa"), (1, 2, "ab"), (2, 0, "c"), (3, 0, "")]


def test_hot_key_gaps_and_median(skewed):
    found = {r["key"]: r for r in gaps.gap_stats(skewed, "key", "item", stretch=100).collect()}
    assert found[0]["n"] == ROWS // 3 and found[0]["median"] == 3.0 and found[0]["last"] == ROWS - 3
    weighted = skewed.groupBy("key", "item").agg(F.count("*").alias("w"))
    rows = {r["key"]: r["median"] for r in medians.exact_medians(weighted, ["key"], "item", "w", small_domain=10).collect()}
    assert rows[0] == (ROWS - 3) / 2
