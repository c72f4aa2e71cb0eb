"""A Bloom filter lets the same rows pass however large it is."""

import pytest

from tallyworks.operators import bloom


def test_same_keys_pass_a_filter_that_is_not_broadcast(spark, monkeypatch):
    keys = spark.range(4000).selectExpr("int(id) AS id")
    members = spark.range(300).selectExpr("id * 3 AS m")
    small = sorted(r.id for r in bloom.bloom_filter_keys(keys, "id", members, "m", 0.1).collect())
    repeated = members.union(members).union(members)
    assert sorted(r.id for r in bloom.bloom_filter_keys(keys, "id", repeated, "m", 0.1).collect()) == small
    monkeypatch.setattr(bloom, "MAX_BITS", 64)
    assert sorted(r.id for r in bloom.bloom_filter_keys(keys, "id", members, "m", 0.1).collect()) == small
    assert small == list(range(0, 900, 3))


@pytest.mark.parametrize("exact_on", [None, ["id"]])
def test_same_texts_pass_at_every_size(spark, monkeypatch, exact_on):
    texts = [(1, "Rain fell"), (1, "zzz"), (None, "Rain again"), (2, "dry"), (2, None), (None, "Snow"), (1, "Rain fell")]
    texts += [(i, f"t{i} u{i}") for i in range(3, 400)]
    rows = spark.createDataFrame(texts, "id int, t string")
    members = spark.createDataFrame([("Rain",), ("Snow",), *[(f"v{i}",) for i in range(50)]], "m string")
    found = []
    for max_bytes, bits in ((1 << 20, 1 << 27), (0, 1 << 27), (0, 1)):
        monkeypatch.setattr(bloom, "MAX_BITS", bits)
        passed = bloom.bloom_filter_tokens(rows, "t", members, "m", 0.1, exact_on=exact_on, max_bytes=max_bytes)
        found.append(sorted((r.id or 0, r.t) for r in passed.collect()))
    assert found[0] == found[1] == found[2]
    assert exact_on is None or found[0] == [(0, "Rain again"), (0, "Snow"), (1, "Rain fell"), (1, "Rain fell")]
