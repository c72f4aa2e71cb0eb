"""Gaps over ranges, and medians by narrowing, where one key or value has nearly all rows."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from tallyworks.operators import gaps, medians


def test_one_key_lies_in_several_ranges(spark):
    rounds = random.Random(2).sample(range(10**6), 3000)
    df = spark.createDataFrame([(1, r) for r in rounds] + [(2, 5)], "k int, r bigint").repartition(4)
    looked = gaps._looked_back(gaps._seen(df, "k", "r"), "k", "r", 200)
    assert looked.where("k = 1").select("_range").distinct().count() >= 10
    assert looked.where("_before is null").count() == looked.select("_range").distinct().count()
    expected = [b - a for a, b in zip([0, *sorted(rounds)], sorted(rounds), strict=False)]
    found = gaps.gaps(df, "k", "r", stretch=200)
    assert [r["gap"] for r in found.where("k = 1").orderBy("r").collect()] == expected
    assert [tuple(r) for r in found.where("k = 2").collect()] == [(2, 5, 5)]


def test_no_window_is_partitioned_by_the_key(spark):
    df = spark.createDataFrame([(1, 2), (1, 5)], "k int, r bigint")
    plan = gaps.gaps(df, "k", "r")._jdf.queryExecution().analyzed().toString()
    assert "windowspecdefinition(k" not in plan and "Window [" not in plan.replace("Window [lag(_last", "")


def test_keys_of_other_types_and_whole_ranges_of_one_key(spark):
    data = [(k, r) for k in ("a", "b\x00", "é") for r in (-3, 0, 7, 2**40)]
    df = spark.createDataFrame(data, "k string, r bigint")
    for rows in (1, 2, 3, 100):
        found = sorted((r["k"], r["r"], r["gap"]) for r in gaps.gaps(df, "k", "r", stretch=rows).collect())
        expected = [(k, r, r - p) for k in ("a", "b\x00", "é") for p, r in ((0, -3), (-3, 0), (0, 7), (7, 2**40))]
        assert found == expected


@pytest.mark.parametrize("small_domain, ranges", [(0, 16), (20, 4), (100, 256)])
def test_median_where_one_value_has_nearly_all_rows(spark, small_domain, ranges):
    rng = random.Random(small_domain)
    spread = {i: rng.randrange(1, 4) for i in range(-400, 800)}
    groups = {
        "below": spread | {-5000: 1_000_000},
        "above": spread | {5000: 10**12},
        "inside": spread | {17: 10**9},
        "even": {i: 1 for i in range(1000)},
        "halves": {1: 500, 2: 500},
        "tiny": {3: 1},
    }
    rows = [(g, float(v), w) for g, values in groups.items() for v, w in values.items()]
    df = spark.createDataFrame(rows, "g string, v double, w bigint").repartition(4)
    found = {r["g"]: r["median"] for r in medians.exact_medians(df, ["g"], "v", "w", small_domain=small_domain, ranges=ranges).collect()}
    assert found == {"below": -5000.0, "above": 5000.0, "inside": 17.0, "even": 499.5, "halves": 1.5, "tiny": 3.0}


def test_narrowing_ends_with_values_close_together(spark):
    values = [1.0 + i * 2.0**-50 for i in range(300)] + [1e300, -1e300, 0.0]
    df = spark.createDataFrame([("g", v, 1) for v in values], "g string, v double, w bigint")
    found = medians.exact_medians(df, ["g"], "v", "w", small_domain=2, ranges=8).first()["median"]
    assert found == statistics.median(values)


def test_row_mass_does_not_widen_a_round(spark):
    """The range that goes on holds about one in ``ranges`` of the values, though one of them has 99 of 100 rows."""
    weighted = spark.range(2000).select(F.lit("g").alias("g"), F.col("id").cast("double").alias("v"), F.when(F.col("id") == 3, 200_000).otherwise(1).cast("bigint").alias("w"))
    left = weighted.withColumns({"_total": F.lit(201_999).cast("bigint"), "_before": F.lit(0).cast("bigint")})
    _, bins = medians._histogram(left, ["g"], "v", "w", 20)
    rows = bins.collect()
    assert len(rows) == 20 and max(r["_different"] for r in rows) <= 200
