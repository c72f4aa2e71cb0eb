"""Blocked Bloom filters: rate, sizes, and the plan of a probe."""

import pytest
from pyspark.sql import functions as F

from tallyworks.operators import bloom


@pytest.mark.parametrize("rate", [0.2, 0.01, 0.0005])
def test_number_of_blocks_keeps_the_rate(rate):
    blocks = bloom.block_count(100_000, rate)
    assert bloom._rate(100_000 / blocks) <= rate < bloom._rate(100_000 / (blocks - blocks // 50 - 1))
    assert bloom.block_count(0, rate) == 1 and bloom.block_count(200_000, rate) == pytest.approx(2 * blocks, abs=2)


def test_rate_must_lie_between_0_and_1():
    for rate in (0, 1, -1):
        with pytest.raises(ValueError):
            bloom.block_count(10, rate)


@pytest.mark.parametrize("rate", [0.1, 0.01])
def test_no_member_is_lost_and_few_others_pass(spark, rate):
    members = spark.range(20_000).select((F.col("id") * 3).alias("m"))
    keys = spark.range(0, 120_000).withColumnRenamed("id", "key")
    passed = {r.key for r in bloom.bloom_filter_keys(keys, "key", members, "m", rate, exact=False).collect()}
    assert passed >= set(range(0, 60_000, 3))
    others = len(passed) - 20_000
    assert 0 < others < 1.5 * rate * 100_000


def test_same_rows_pass_whether_blocks_are_sent_or_shuffled(spark, monkeypatch):
    members = spark.range(5000).select((F.col("id") * 2).cast("string").alias("m"))
    keys = spark.range(0, 30_000).selectExpr("if(id % 3 = 0, 0, id) AS key").union(spark.sql("SELECT cast(null AS bigint)"))
    found = []
    for bits in (1 << 27, 1):
        monkeypatch.setattr(bloom, "MAX_BITS", bits)
        passed = bloom.bloom_filter_keys(keys, "key", members, "m", 0.05, exact=False)
        found.append(sorted(r.key for r in passed.collect()))
    assert found[0] == found[1] and found[0].count(0) == 10_000


@pytest.mark.parametrize("blocks", [1, 1000])
def test_a_filter_holds_its_members_in_any_number_of_blocks(spark, monkeypatch, blocks):
    monkeypatch.setattr(bloom, "block_count", lambda members, rate: blocks)
    members = spark.createDataFrame([(f"m{i}",) for i in range(40)], "m string")
    rows = spark.createDataFrame([(f"m{i} x{i}",) for i in range(0, 80, 2)], "t string")
    table = bloom.blocked_bloom(members, "m", 40, 0.01)
    assert table.table.count() <= blocks
    assert table.keep(members, "m").count() == 40
    probed = rows.where(table.held().any_member(F.split("t", " "))).count()
    assert probed >= 20 and (blocks == 1 or probed < 25)
    exact = bloom.bloom_filter_keys(members.union(rows), "m", members, "m", 0.01)
    assert exact.count() == 40


def test_a_probe_is_one_join_without_python(spark):
    members = spark.range(1000).withColumnRenamed("id", "m")
    plan = bloom.bloom_filter_keys(spark.range(5000), "id", members, "m", exact=False)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("members", [0, 300])
def test_a_filter_is_written_and_read(spark, tmp_path, members):
    df = spark.range(members).withColumnRenamed("id", "m")
    table = bloom.blocked_bloom(df, "m", members, 0.01)
    table.write(str(tmp_path / "bloom"))
    again = bloom.read_bloom(spark, str(tmp_path / "bloom"))
    assert again.blocks == table.blocks
    keys = spark.range(3000)
    assert sorted(r.id for r in again.keep(keys, "id").collect()) == sorted(r.id for r in table.keep(keys, "id").collect())
    assert again.keep(keys, "id").count() >= members
