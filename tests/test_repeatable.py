"""Samples, generated rows, counted writes and readers that do not depend on how the work is cut up."""

import math
import uuid

import pytest
from pyspark.sql import functions as F

from tallyworks.operators import filters
from tallyworks.sources import corpus, delimited, sinks, synthetic


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_sample_is_a_function_of_the_rows(spark):
    df = spark.range(5000).selectExpr("id", "if(id % 5 = 0, null, concat('t', id)) AS t")
    two, eight = (filters.sample_repeatable(df.repartition(n), 20, seed=3) for n in (2, 8))
    assert rows(two) == rows(eight) and abs(two.count() - 1000) < 5 * math.sqrt(800)
    assert set(rows(filters.sample_repeatable(df, 5, seed=3))) < set(rows(two)) < set(rows(df))
    assert rows(filters.sample_repeatable(df, 20, seed=4)) != rows(two)
    assert filters.sample_repeatable(df, 0).count() == 0 and rows(filters.sample_repeatable(df, 100)) == rows(df)


@pytest.mark.parametrize("lot", [7, 100_000])
def test_copies_are_drawn_each_by_itself(spark, lot):
    df = spark.range(4000).selectExpr("1 AS a", "cast(null AS string) AS b").union(spark.range(50).selectExpr("id", "'x'"))
    drawn = filters.sample_repeatable(df, 30, seed=1, lot=lot)
    copies = drawn.where("b is null").count()
    assert abs(copies - 1200) < 5 * math.sqrt(840)
    assert rows(drawn) == rows(filters.sample_repeatable(df.repartition(5), 30, seed=1))


def test_generated_rows_do_not_depend_on_tasks_or_how_words_are_found(spark):
    words = spark.createDataFrame([(w,) for w in ("red", "green", "blue", "red", None)], "w string")
    cities = spark.createDataFrame([("Oslo",), ("Rome",)], "c string")
    made = [synthetic.synthetic_comments(spark, 300, words, "w", tasks=n, seed=2, join_words=j) for n, j in ((2, False), (8, False), (3, True))]
    assert rows(made[0]) == rows(made[1]) == rows(made[2])
    users = [synthetic.synthetic_users(spark, 200, words, "w", cities, "c", tasks=n, seed=2, join_words=j) for n, j in ((2, False), (5, True))]
    assert rows(users[0]) == rows(users[1])
    assert rows(synthetic.synthetic_comments(spark, 300, words, "w", seed=3)) != rows(made[0])


def test_joined_words_have_no_cap(spark, monkeypatch):
    monkeypatch.setattr(synthetic, "fits_broadcast", lambda df, size: False)
    words = spark.createDataFrame([("red",), ("blue",)], "w string")
    made = synthetic.synthetic_comments(spark, 20, words, "w", join_words=True).collect()
    assert len(made) == 20 and {w for r in made for w in r.Text.split(" ")} == {"red", "blue"}
    none = synthetic.synthetic_comments(spark, 5, words.limit(0), "w", join_words=True).collect()
    assert [r.Text for r in none] == [""] * 5


def test_numbers_are_dense_and_in_order(spark):
    values = spark.range(3000).selectExpr("concat('w', id * 7919 % 3000) AS w").repartition(5)
    dense, n = synthetic.numbered(values.union(values), "w")
    assert n == 3000
    assert [r["w"] for r in dense.orderBy("_number").collect()] == sorted(f"w{i}" for i in range(3000))
    assert [r["_number"] for r in dense.orderBy("_number").collect()] == list(range(3000))


def test_an_empty_cell_is_not_a_missing_one(spark, tmp_path):
    path = tmp_path / "wifi.csv"
    path.write_text('Loc,Detail,Lat\nSeoul,a,1.5\n,b,\nBusan\n"x,y,2,more\n\n', encoding="utf-8")
    found = delimited.read_cells(spark, str(path), {"Loc": "string", "Detail": "string", "Lat": "double"})
    assert [tuple(r) for r in found.collect()] == [("Seoul", "a", 1.5), ("", "b", None), ("Busan", None, None), ('"x', "y", 2.0), ("", None, None)]


def test_files_are_documents_and_empty_ones_count(spark, tmp_path):
    for name, text in (("a.txt", "one two\none"), ("b.txt", "two"), ("empty.txt", ""), ("c.txt", "...")):
        (tmp_path / name).write_text(text)
    assert sorted(r["bytes"] for r in corpus.corpus_files(spark, str(tmp_path)).collect()) == [3, 3, 11]
    found = {r["word"]: (r["tf"], r["df"], r["weight"]) for r in corpus.file_term_weights(spark, str(tmp_path)).collect()}
    assert found == {"one": (2, 1, pytest.approx(2 * math.log(4))), "two": (2, 2, pytest.approx(2 * math.log(2)))}
    plan = corpus.corpus_files(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def _jobs(spark, action):
    tracker = spark.sparkContext.statusTracker()
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    action()
    jobs = len(tracker.getJobIdsForGroup(group))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return jobs


def test_a_write_counts_what_it_writes(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "if(id % 3 = 0, 'a', 'b') AS bin")
    found = {}
    counters = {"a": F.col("bin") == "a", "large": F.col("id") >= 990, "none": F.col("id") < 0}
    jobs = _jobs(spark, lambda: found.update(sinks.write_counted(df, str(tmp_path / "plain"), counters)))
    assert found == {"a": 334, "large": 10, "none": 0} and jobs == 1
    assert spark.read.parquet(str(tmp_path / "plain")).count() == 1000
    assert sinks.write_counted(df, str(tmp_path / "bins"), counters, bin_column="bin") == found
    assert spark.read.parquet(str(tmp_path / "bins")).where("bin = 'a'").count() == 334


def test_results_are_written_together(spark, tmp_path):
    first = spark.createDataFrame([(1, "a"), (2, None)], "k int, t string")
    second = spark.createDataFrame([("a", 5.5)], "t string, v double")
    path = str(tmp_path / "together")
    assert _jobs(spark, lambda: sinks.write_together({"first": first, "second": second}, path)) == 1
    assert rows(sinks.read_together(spark, path, "first", ["k", "t"])) == [(1, "a"), (2, None)]
    assert rows(sinks.read_together(spark, path, "second", ["t", "v"])) == [("a", 5.5)]
