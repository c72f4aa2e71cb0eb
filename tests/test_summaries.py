import random
import statistics

import pytest
from pyspark.sql import functions as F

from tallyworks.operators import counting, gaps, medians, summaries, topk


def rows(df, *columns):
    return sorted(tuple(r[c] for c in (columns or df.columns)) for r in df.collect())


def test_word_counts(spark):
    lines = spark.createDataFrame([("a dog IS a dog",), ("The dog's",), (None,), ("42",)], "t string")
    assert rows(counting.word_count(lines, "t")) == [("a", 2), ("dog", 2), ("dogs", 1), ("is", 1), ("the", 1)]
    split = counting.word_count_split(lines, "t")
    assert rows(split.filter("is_stopword"), "word", "n") == [("a", 2), ("is", 1)]
    assert rows(counting.listed_word_count(lines, "t", ["dog", "cat"])) == [("dog", 2)]
    stop = spark.createDataFrame([("A the",)], "s string")
    assert rows(counting.word_count_without(lines, "t", stop, "s")) == [("dog", 2), ("dogs", 1), ("is", 1)]


def test_kept_and_listed_counts_agree(spark):
    lines = spark.createDataFrame([("i have a cat she is",), ("have a is",)], "t string")
    listed = rows(counting.listed_word_count(lines, "t"))
    split = counting.word_count_split(lines, "t").filter(F.col("word").isin("a", "is", "am", "have"))
    assert rows(split, "word", "n") == listed


def test_min_max_count(spark):
    data = [("u1", "2020-01-02"), ("u1", "2020-01-01"), ("u2", "2020-05-05"), (None, "2020-01-01"), ("u3", None)]
    df = spark.createDataFrame(data, "u string, d string").withColumn("d", F.col("d").cast("timestamp_ntz"))
    found = [(r["u"], str(r["first"])[:10], str(r["last"])[:10], r["n"]) for r in summaries.min_max_count(df, "u", "d").collect()]
    assert sorted(found) == [("u1", "2020-01-01", "2020-01-02", 2), ("u2", "2020-05-05", "2020-05-05", 1)]


def test_averages(spark):
    data = [("s", 1.0, "low"), ("s", 3.0, "high"), ("s", 5.0, "odd"), ("t", 2.0, None)]
    df = spark.createDataFrame(data, "k string, m double, c string")
    assert rows(summaries.averages_by(df, "k", ["m"], "c")) == [("s", 3, 3.0, 50.0)]
    assert rows(summaries.average_by(df, F.col("k"), F.col("m"), name="k")) == [("s", 3, 3.0), ("t", 1, 2.0)]


def expected_medians(data):
    groups = {}
    for key, value in data:
        groups.setdefault(key, []).append(value)
    return groups


@pytest.mark.parametrize("small_domain, ranges", [(100_000, 4096), (0, 4096), (0, 100), (0, 4), (0, 2)])
def test_exact_medians(spark, small_domain, ranges):
    rng = random.Random(3)
    data = [(rng.choice("abc"), rng.choice([rng.random(), 0.25, 0.5])) for _ in range(600)]
    data += [("one", 7.0), ("two", 1.0), ("two", 2.0), ("same", 3.0), ("same", 3.0)]
    data += [("hot", 0.25)] * 900 + [("hot", float(i)) for i in range(40)]
    df = spark.createDataFrame(data, "k string, v double")
    weighted = df.groupBy("k", "v").agg(F.count("*").alias("w"))
    found = medians.exact_medians(weighted, ["k"], "v", "w", small_domain=small_domain, ranges=ranges)
    expected = {k: statistics.median(v) for k, v in expected_medians(data).items()}
    assert {r["k"]: r["median"] for r in found.collect()} == pytest.approx(expected)


def test_range_of_counts_the_cuts_below(spark):
    cuts = [float(i) for i in range(0, 300, 3)]
    numbers = spark.range(-5, 320).select(F.col("id").cast("double").alias("v"))
    for block in (1, 7, 64, 100, 200):
        found = numbers.select("v", medians._range_of(F.col("v"), cuts, block).alias("r")).collect()
        assert all(r["r"] == sum(c < r["v"] for c in cuts) for r in found)


def test_median_and_deviation(spark):
    data = [(1, 2.0), (1, 4.0), (1, 9.0), (2, 5.0), (3, 1.0), (3, 2.0), (4, None)]
    df = spark.createDataFrame(data, "k int, v double")
    found = {r["k"]: r for r in summaries.median_and_deviation(df, F.col("k"), F.col("v"), name="k").collect()}
    assert set(found) == {1, 2, 3}
    assert found[1]["median"] == 4.0 and found[3]["median"] == 1.5
    assert found[1]["stddev"] == pytest.approx(statistics.stdev([2, 4, 9])) and found[2]["stddev"] is None


def brute_gaps(data):
    out, by_key = [], {}
    for key, at in data:
        by_key.setdefault(key, []).append(at)
    for key, moments in by_key.items():
        before = 0
        for at in sorted(moments):
            out.append((key, at, at - before))
            before = at
    return out


@pytest.mark.parametrize("stretch, chunk", [(None, 1_000_000), (3, 2), (1, 1), (7, 3)])
def test_gaps(spark, stretch, chunk):
    rng = random.Random(5)
    data = [(rng.randrange(4), rng.randrange(-5, 60)) for _ in range(150)] + [(9, 12)] * 8 + [(8, 10**17), (8, 10**17 + 1)]
    df = spark.createDataFrame(data, "k int, r bigint")
    expected = brute_gaps(data)
    assert rows(gaps.gaps(df, "k", "r", stretch=stretch, chunk=chunk)) == sorted(expected)
    found = {r["k"]: r for r in gaps.gap_stats(df.filter("k < 5"), "k", "r", stretch=stretch).collect()}
    for key in range(4):
        values = [g for k, _, g in expected if k == key]
        assert found[key]["n"] == len(values) and found[key]["median"] == statistics.median(values)
        assert found[key]["average"] == pytest.approx(statistics.mean(values))
        assert found[key]["stddev"] == pytest.approx(statistics.stdev(values))
        assert found[key]["last"] == max(r for k, r in data if k == key)


def test_gap_stats_of_a_single_round(spark):
    row = gaps.gap_stats(spark.createDataFrame([(1, 4)], "k int, r int"), "k", "r").first()
    assert (row["n"], row["average"], row["median"], row["stddev"], row["last"]) == (1, 4.0, 4.0, None, 4)


def test_frequencies(spark):
    draws = spark.createDataFrame([(1, 2, 2), (2, 3, 1), (1, None, 9)], "a int, b int, c int")
    columns = ["a", "b", "c"]
    assert rows(counting.value_frequency(draws, columns)) == [(1, 2), (2, 3), (3, 1)]
    assert ("a", 1, 1) in rows(counting.position_frequency(draws, columns))
    shares = counting.relative_frequency(draws, columns)
    assert sum(r["share"] for r in shares.collect()) == pytest.approx(1.0)


def test_distinct_count_is_the_number_of_distinct_values(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "k string")
    assert counting.distinct_count(df, "k").first()[0] == counting.distinct_values(df, "k").count() == 2
    ordered = [r[0] for r in counting.distinct_values(df, "k", sort=True).collect()]
    assert ordered == ["a", "b"]


def test_top_k(spark):
    data = [(i, v) for i, v in enumerate([5, 9, 9, 1, 7, 7, 7, None])]
    df = spark.createDataFrame(data, "id int, v int")
    assert [(r.v, r.id) for r in topk.top_k(df, "v", ["id"], 4).collect()] == [(9, 1), (9, 2), (7, 4), (7, 5)]
    assert [(r.v, r.id) for r in topk.top_k_distinct(df, "v", ["id"], 3).collect()] == [(9, 2), (7, 6), (5, 0)]
    assert topk.top_k(df, "v", ["id"], 100).count() == 7
    assert topk.top_k_distinct(df, "v", ["id"], 100).count() == 4


def test_nan_is_a_value(spark):
    df = spark.createDataFrame([("a", float("nan")), ("a", 2.0), ("a", None)], "k string, v double")
    assert summaries.average_by(df, F.col("k"), F.col("v"), name="k").first()["n"] == 2


def test_two_results_of_one_scan(spark, tmp_path):
    rows = [(1, 5, "b a"), (1, 3, None), (None, 4, "a"), (2, None, "c's stop")]
    spark.createDataFrame(rows, "k int, m int, t string").write.parquet(str(tmp_path / "rows"))
    stop = spark.createDataFrame([("stop",)], "w string")
    spans, words = summaries.min_max_and_words(spark.read.parquet(str(tmp_path / "rows")), "k", "m", "t", stop, "w")
    assert [tuple(r) for r in spans.collect()] == [(1, 3, 5, 2)]
    assert sorted(map(tuple, words.collect())) == [("a", 2), ("b", 1), ("cs", 1)]
    for result in (spans, words):
        assert "FileScan" not in result._jdf.queryExecution().executedPlan().toString()
