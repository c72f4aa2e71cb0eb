import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyworks.operators import filters, index, itemsets, organize


def test_filters(spark):
    lines = spark.createDataFrame([("abc",), ("xabc",), ("abc\n",), (None,)], "value string")
    assert [r[0] for r in filters.grep(lines, "value", "a.c|zzz").collect()] == ["abc"]
    numbers = spark.createDataFrame([(1, None), (5, "1"), (9, "2")], "n int, kind string")
    assert filters.at_least(numbers, "n", 5).count() == 2
    assert sorted(r["n"] for r in filters.not_category(numbers, "kind", "1").collect()) == [1, 9]
    assert lines.filter(filters.contains_text("value", "XA")).count() == 1


def test_sample(spark):
    df = spark.range(20_000)
    first, second = (filters.sample_percent(df, 20, seed=3).collect() for _ in range(2))
    assert first == second
    assert abs(len(first) - 4000) < 5 * (20_000 * 0.2 * 0.8) ** 0.5


def test_shuffle_keeps_the_rows(spark):
    df = spark.createDataFrame([(i % 7, "x") for i in range(300)] + [(1, "copy")] * 200, "a int, b string")
    mixed = organize.shuffle_rows(df, 10, seed=1)
    assert mixed.rdd.getNumPartitions() == 10
    assert Counter(mixed.collect()) == Counter(df.collect())
    sizes = mixed.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) <= 2 * 50
    assert mixed.collect() != df.collect()


def test_anonymize(spark):
    df = spark.createDataFrame([(1, 2, "2011-01-01T10:00:00.000", "t"), (3, 4, "2012-02-02", None)], "Id int, UserId int, d string, t string")
    found = organize.anonymize(df, ["Id", "UserId"], "d", 2)
    assert sorted(map(tuple, found.collect()), key=str) == [("2011-01-01", "t"), ("2012-02-02", None)]
    rows, users = organize.anonymize_and_distinct(df.unionByName(df), ["Id", "UserId"], "d", "UserId")
    assert rows.count() == 4 and users.count() == 2


def test_bins(spark):
    data = [
        (1, "&lt;sql&gt;&lt;etl&gt;", "x"),
        (2, "&lt;Etl&gt;&lt;etl&gt;", "about SQL"),
        (3, None, "sql"),
        (4, "&lt;other&gt;", None),
    ]
    df = spark.createDataFrame(data, "id int, tags string, body string")
    bins = organize.tag_bins("tags", "body", {"sql": "sql-tag", "etl": "etl-tag"}, "sql", "sql-post")
    found = organize.to_bins(df, bins).select("id", "bin").collect()
    assert {tuple(r) for r in found} == {(1, "sql-tag"), (1, "etl-tag"), (2, "sql-post"), (2, "etl-tag")}
    assert len(found) == 4


def test_inverted_index(spark):
    data = [(1, 'see &quot;http://W.org/A#x&quot;'), (3, 'a "http://w.org/a" b'), (3, 'a "http://w.org/a"'), (2, "none")]
    df = spark.createDataFrame(data, "id int, body string")
    found = index.inverted_index(df, "body", "id", "http://w.org").collect()
    assert [tuple(r) for r in found] == [("http://w.org/a", 0, "1 3 3")]
    parts = index.inverted_index(df, "body", "id", "http://w.org", part_items=1).collect()
    assert sorted(" ".join(r["ids"] for r in parts).split()) == ["1", "3", "3"]


@pytest.mark.parametrize("whole_rows", [False, True])
def test_term_weights(spark, whole_rows):
    import math

    df = spark.createDataFrame([("d1", "a b a"), ("d2", "a c"), ("d3", "42")], "doc string, t string")
    found = {r["word"]: r for r in index.term_weights(df, "doc", "t", whole_rows=whole_rows).collect()}
    assert {w: (r["tf"], r["df"]) for w, r in found.items()} == {"a": (3, 2), "b": (1, 1), "c": (1, 1)}
    assert found["a"]["weight"] == pytest.approx(3 * math.log(3 / 2))


def test_term_weights_of_documents_in_lines(spark):
    df = spark.createDataFrame([("d1", "a b"), ("d1", "a"), ("d2", "b")], "doc string, t string")
    found = {r["word"]: (r["tf"], r["df"]) for r in index.term_weights(df, "doc", "t", documents=2).collect()}
    assert found == {"a": (2, 1), "b": (2, 2)}


def brute_itemsets(baskets, least):
    counts = Counter()
    for items in baskets:
        for size in range(1, len(items) + 1):
            counts.update(itertools.combinations(sorted(items), size))
    return {s: n for s, n in counts.items() if n >= least}


@pytest.mark.parametrize("least", [1, 2, 5, 40])
def test_itemsets_against_all_subsets(spark, least):
    rng = random.Random(least)
    names = ["apple", "beer", "corn", "dill", "egg", "fig"]
    baskets = [set(rng.sample(names, rng.randint(1, 5))) for _ in range(40)]
    lines = [(t, i) for t, items in enumerate(baskets) for i in items]
    lines += lines[:10] + [(99, None), (None, "egg")]
    df = spark.createDataFrame(lines, "t int, item string")
    found = itemsets.frequent_itemsets(df, "t", "item", least)
    expected = brute_itemsets(baskets, least)
    assert {tuple(r["items"]): r["support"] for r in found.collect()} == expected
    three = itemsets.frequent_itemsets(df, "t", "item", least, sizes=[3]).collect()
    assert {tuple(r["items"]) for r in three} == {s for s in expected if len(s) == 3}
    single = itemsets.frequent_items(df, "t", "item", least)
    assert {(r["item"],): r["support"] for r in single.collect()} == {s: n for s, n in expected.items() if len(s) == 1}


def test_itemsets_of_nothing(spark):
    df = spark.createDataFrame([(1, "a")], "t int, item string")
    assert itemsets.frequent_itemsets(df, "t", "item", 2).count() == 0
    kept = itemsets.frequent_baskets(df, "t", "item", 1).collect()
    assert [tuple(r) for r in kept] == [(1, ["a"])]
