import pytest
from pyspark.sql import functions as F

from tallyworks import session
from tallyworks.operators import bloom, joins, nesting


@pytest.fixture(scope="module")
def sides(spark):
    left = spark.createDataFrame(
        [(1, "a"), (2, "b"), (2, "b2"), (3, "c"), (None, "n")], "uid int, name string"
    )
    right = spark.createDataFrame(
        [(1, "x"), (1, "y"), (2, "z"), (9, "q"), (None, "m")], "cid int, txt string"
    )
    return left, right


def pairs(df):
    return sorted(((r["name"] or "", r["txt"] or "") for r in df.collect()))


INNER = [("a", "x"), ("a", "y"), ("b", "z"), ("b2", "z")]


@pytest.mark.parametrize(
    "how, expected",
    [
        ("inner", INNER),
        ("left", [*INNER, ("c", "")]),
        ("right", [("", "q"), *INNER]),
        ("full", [("", "q"), *INNER, ("c", "")]),
        ("anti", [("", "q"), ("c", "")]),
    ],
)
def test_keyed_join(sides, how, expected):
    left, right = sides
    assert pairs(joins.keyed_join(left, right, "uid", "cid", how)) == expected


def test_anti_is_full_without_inner(sides):
    left, right = sides
    full, inner, anti = (pairs(joins.keyed_join(left, right, "uid", "cid", how)) for how in ("full", "inner", "anti"))
    assert sorted(anti + inner) == full


def test_replicated_join_agrees_with_shuffled(sides):
    left, right = sides
    small = joins.one_per_key(left, "uid", ["name"])
    expected = pairs(joins.keyed_join(small, right, "uid", "cid", "inner"))
    assert pairs(joins.replicated_join(right, left, "cid", "uid", "inner", order=["name"])) == expected
    outer = pairs(joins.replicated_join(right, left, "cid", "uid", "left", order=["name"]))
    assert outer == sorted([*expected, ("", "q")])


def test_replicated_join_without_room(sides, monkeypatch):
    left, right = sides
    monkeypatch.setattr(joins, "broadcast_if_small", lambda df: session.broadcast_if_small(df, max_bytes=1))
    assert ("b2", "z") in pairs(joins.replicated_join(right, left, "cid", "uid", "left", order=["name"]))


@pytest.mark.parametrize("how, n", [("inner", 2), ("left", 3), ("full", 4), ("anti", 2)])
def test_sides_may_share_names(spark, how, n):
    users = spark.createDataFrame([(1, "u1"), (2, "u2")], "Id int, CreationDate string")
    comments = spark.createDataFrame([(7, 1, "c1"), (8, 1, "c2"), (9, 5, "c3")], "id int, UserId int, CreationDate string")
    joined = joins.keyed_join(users, comments, "Id", "UserId", how)
    assert joined.columns[:2] == ["Id", "CreationDate"] or how == "anti"
    assert joined.count() == n
    if how == "inner":
        assert sorted(map(tuple, joined.collect())) == [(1, "u1", 7, 1, "c1"), (1, "u1", 8, 1, "c2")]
    swapped = joins.keyed_join(comments, users, "UserId", "Id", "inner")
    assert {(r["CreationDate"], r["CreationDate_right"]) for r in swapped.collect()} == {("c1", "u1"), ("c2", "u1")}
    copied = joins.replicated_join(comments, users, "UserId", "Id", "left")
    assert copied.count() == 3 and copied.filter("Id_right is null").count() == 1


def test_unknown_kind(sides):
    with pytest.raises(ValueError):
        joins.keyed_join(*sides, "uid", "cid", "cross")


def test_word_count_by_place(spark):
    people = spark.createDataFrame([(1, "Boston MA"), (2, None), (3, "Oslo")], "id int, place string")
    texts = spark.createDataFrame([(1, "hi hi"), (1, "yo"), (2, "hi"), (7, "gone")], "by int, text string")
    found = joins.word_count_by_place(people, "id", "place", texts, "by", "text")
    assert sorted(map(tuple, found.collect())) == [("MA", "hi", 2), ("MA", "yo", 1), ("NullOrEmpty", "hi", 1)]


def nested(df):
    return sorted((r["pid"], r["part"], [c["c"] for c in r["children"]]) for r in df.collect())


@pytest.fixture(scope="module")
def family(spark):
    parents = spark.createDataFrame([(1,), (2,), (3,), (None,)], "pid int")
    children = spark.createDataFrame([(1, "b"), (1, "a"), (2, "z"), (8, "o"), (None, "n")], "ref int, c string")
    return parents, children


def test_nest(family):
    parents, children = family
    assert nested(nesting.nest(parents, children, "pid", "ref", ["c"])) == [(1, 0, ["a", "b"]), (2, 0, ["z"]), (3, 0, [])]
    kept = nesting.nest(parents, children, "pid", "ref", ["c"], keep_childless=False)
    assert nested(kept) == [(1, 0, ["a", "b"]), (2, 0, ["z"])]


def test_last_of_several_parents_counts(spark, family):
    parents = spark.createDataFrame([(1, "old"), (1, "new")], "pid int, title string")
    found = nesting.nest(parents, family[1], "pid", "ref", ["c"], order=["title"]).collect()
    assert [(r["title"], len(r["children"])) for r in found] == [("old", 2)]


def test_nest_by_role(spark):
    posts = spark.createDataFrame([(1, None, 1), (2, 1, 2), (3, 1, 2), (4, None, 1), (5, 99, None)], "id int, ref int, kind int")
    found = nesting.nest_by_role(posts, F.col("kind") == 1, "id", "ref", ["id"])
    assert sorted((r["id"], [c["id"] for c in r["children"]]) for r in found.collect()) == [(1, [2, 3]), (4, [])]


@pytest.mark.parametrize("part_items", [1, 3, 10, 1000])
def test_large_groups_are_continued_and_whole(spark, part_items):
    data = [(1, f"c{i:03d}") for i in range(200)] + [(1, "same")] * 150 + [(2, "x"), (2, "y")]
    children = spark.createDataFrame(data, "k int, c string").repartition(6)
    found = nesting.gather(children, ["k"], F.struct("c"), out="items", part_items=part_items).collect()
    whole = sorted((r["k"], item["c"]) for r in found for item in r["items"])
    assert whole == sorted(data)
    for key in (1, 2):
        parts = sorted((r["part"], [item["c"] for item in r["items"]]) for r in found if r["k"] == key)
        assert [part for part, _ in parts] == list(range(len(parts)))
        assert [c for _, items in parts for c in items] == sorted(c for k, c in data if k == key)
        assert {len(items) for _, items in parts[:-1]} <= {part_items} and len(parts[-1][1]) <= part_items


def test_bloom_has_no_false_negatives_and_few_positives(spark):
    members = spark.range(2000).select((F.col("id") * 7).alias("m"))
    rate = 0.02
    bits, hashes = bloom.filter_size(2000, rate)
    assert (bits, hashes) == (16284, 6)
    keys = spark.range(0, 42_000).select("id")
    passed = bloom.bloom_filter_keys(keys, "id", members, "m", rate)
    inside = passed.join(members, F.col("id") == F.col("m"), "left_semi").count()
    assert inside == 2000
    assert passed.count() - inside < 2 * rate * 40_000


def test_bloom_null_and_empty(spark):
    keys = spark.createDataFrame([(1,), (None,)], "id int")
    none = spark.createDataFrame([], "m int")
    assert bloom.bloom_filter_keys(keys, "id", none, "m").count() == 0
    assert bloom.bloom_filter_keys(keys, "id", keys, "id").count() == 1


def test_bloom_too_large_is_exact(spark, monkeypatch):
    monkeypatch.setattr(bloom, "MAX_BITS", 8)
    keys = spark.range(100)
    members = spark.range(10).withColumnRenamed("id", "m")
    assert bloom.bloom_filter_keys(keys, "id", members, "m").count() == 10
    with pytest.raises(ValueError):
        bloom.build_bloom(members, "m", 10, 0.01)


@pytest.mark.parametrize("max_bytes, bits", [(1 << 20, 1 << 27), (0, 1 << 27), (0, 1)])
def test_token_filter(spark, monkeypatch, max_bytes, bits):
    monkeypatch.setattr(bloom, "MAX_BITS", bits)
    texts = [(1, "some Rain. falls"), (2, "rain"), (3, None), (4, "Rain Rain"), (5, "R'ain"), (6, "")]
    rows = spark.createDataFrame(texts, "id int, t string").repartition(3)
    members = spark.createDataFrame([("Rain",), ("snow",)], "m string")
    found = bloom.bloom_filter_tokens(rows, "t", members, "m", exact_on=["id"], max_bytes=max_bytes)
    assert sorted(r["id"] for r in found.collect()) == [4, 5]


def test_token_filter_from_gzip_members(spark, tmp_path):
    path = str(tmp_path / "members")
    spark.createDataFrame([("Rain",), ("Snow",)], "value string").write.option("compression", "gzip").text(path)
    rows = spark.createDataFrame([(1, "Snow fell"), (2, "nothing here")], "id int, t string")
    found = bloom.bloom_filter_tokens(rows, "t", spark.read.text(path), "value", 0.001)
    assert {r["id"] for r in found.collect()} >= {1}


@pytest.mark.parametrize("both_sides", [False, True])
def test_bloom_nest_equals_plain_nest(spark, both_sides):
    users = spark.createDataFrame([(i, i * 10) for i in range(50)], "pid int, rep int")
    comments = spark.createDataFrame([(i % 70, f"c{i}") for i in range(300)], "ref int, c string")
    found = bloom.bloom_nest(users, "pid", "rep", 200, comments, "ref", ["c"], both_sides=both_sides)
    plain = nesting.nest(users.filter("rep >= 200"), comments, "pid", "ref", ["c"], keep_childless=False)
    assert nested(found) == nested(plain)
