"""Records bounded in bytes, and what a plan of nesting shuffles."""

import pytest
from pyspark.sql import functions as F

from tallyworks.operators import nesting


@pytest.mark.parametrize("part_bytes, part_items", [(100, 1000), (1000, 7), (60, 2), (10**6, 10**6)])
def test_costs_before_an_item_decide_its_part(spark, part_bytes, part_items):
    texts = ["", "ab", "ab", "é" * 20, "x" * 300, None, "zz"] + [f"t{i:02d}" * (i % 5) for i in range(40)]
    children = spark.createDataFrame([(1, t) for t in texts] + [(2, "only")], "k int, t string").repartition(3)
    found = nesting.gather(children, ["k"], F.struct("t"), out="items", part_items=part_items, part_bytes=part_bytes).collect()
    least = -(-part_bytes // part_items)
    expected, cost = {}, 0
    for t in sorted(texts, key=lambda t: (t is not None, (t or "").encode())):
        expected.setdefault(cost // (least * part_items), []).append(t)
        cost += max(least, 16 + len((t or "").encode()))
    assert {r["part"]: [i["t"] for i in r["items"]] for r in found if r["k"] == 1} == expected
    assert [(r["part"], r["items"]) for r in found if r["k"] == 2] == [(0, [("only",)])]


def test_parents_meet_records_not_children(spark):
    parents = spark.createDataFrame([(1, "p" * 50), (2, "q"), (3, "r"), (None, "n")], "id int, body string")
    children = spark.createDataFrame([(1, f"c{i:03d}") for i in range(300)] + [(2, "x"), (9, "orphan"), (None, "none")], "ref int, c string")
    for options in ({}, {"part_items": 40}, {"part_bytes": 400}):
        nested = nesting.nest(parents, children, "id", "ref", ["c"], **options)
        rows = sorted((r["id"], r["part"], [c["c"] for c in r["children"]], r["body"]) for r in nested.collect())
        assert [c for i, _, cs, _ in rows if i == 1 for c in cs] == [f"c{i:03d}" for i in range(300)]
        assert [r for r in rows if r[0] != 1] == [(2, 0, ["x"], "q"), (3, 0, [], "r")]
        assert {r[3] for r in rows if r[0] == 1} == {"p" * 50}
        kept = nesting.nest(parents, children, "id", "ref", ["c"], keep_childless=False, **options)
        assert sorted((r["id"], r["part"]) for r in kept.collect()) == [r[:2] for r in rows if r[0] != 3]


def test_small_groups_take_one_join_and_one_shuffle_of_each_side(spark):
    parents = spark.range(1000).selectExpr("id", "concat('p', id) AS body")
    children = spark.range(5000).selectExpr("id % 1000 AS ref", "id AS c")
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    plan = nesting.nest(parents, children, "id", "ref", ["c"])._jdf.queryExecution().executedPlan().toString()
    spark.conf.set(setting, before)
    initial = plan.split("+- == Initial Plan ==")[-1]
    assert initial.count("Exchange hashpartitioning") == 2 and initial.count("Join") == 1


@pytest.mark.parametrize("part_bytes, part_items", [(10**6, 3), (50, 1000), (7, 1000), (100, 7), (10**6, 1)])
def test_items_that_are_held_are_cut_without_ranges(spark, monkeypatch, part_bytes, part_items):
    children = spark.range(200).selectExpr("id % 7 * (id % 3) AS k", "cast(id * 37 % 101 AS int) AS v").repartition(3)

    def made():
        frame = nesting.gather(children, ["k"], F.struct("v"), out="items", part_items=part_items, part_bytes=part_bytes)
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        return sorted((r["k"], r["part"], [i["v"] for i in r["items"]]) for r in frame.collect()), plan

    cut, plan = made()
    assert "Window" not in plan and "Join" not in plan
    monkeypatch.setattr(nesting, "HELD_ITEMS", 1)
    ranged, plan = made()
    assert "Window" in plan and ranged == cut
