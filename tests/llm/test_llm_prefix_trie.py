"""The trie of rebuilt conversations against one that is built turn by turn."""

import hashlib
import random
import re
import zlib

import pytest

from tallyworks.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth long, fp string, words int"


def brute(rows):
    own = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        if conv is not None:
            own.setdefault(conv, []).append((role or "", text or ""))
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        family = c - (c % 20 if c >= 0 else -(-c % 20))  # the remainder has the sign of the id, as in SQL
        built[c] = tuple(own.get(family, [])[:h] + turns[h:])
    nodes = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append(c)
    children = {}
    for p in nodes:
        if p:
            children.setdefault(p[:-1], []).append(p)
    out = []
    for p, convs in nodes.items():
        below = [q for q in nodes if q[: len(p)] == p]
        saved = sum((len(nodes[q]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", q[-1][1])) for q in below if q)
        ends = ",".join(str(c) for c in sorted(convs) if len(built[c]) == len(p))
        out.append((min(convs), len(p), min(nodes[p[:-1]]) if p else None, len(convs), len(children.get(p, [])), sum(q not in children for q in below), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[0], r[1]))


def found(spark, rows, **options):
    df = spark.createDataFrame([(*r, 5, "x", 1) for r in rows], SCHEMA).repartition(5)
    result = prefix_trie.trie(df, **options)
    assert result.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in result.collect()), key=lambda r: (r[0], r[1]))


@pytest.fixture
def many_shards(spark):
    """Small tables stay in as many ranges as there are shuffle partitions."""
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    yield
    spark.conf.set(setting, before)


def conversations(seed, n, most, texts):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(-45, 130), n):
        for turn in range(r.randrange(1, most)):
            rows.append((c, None if turn == 0 and r.random() < 0.3 else turn, r.choice(["user", "bot", None]), r.choice(texts)))
    return rows


TEXTS = ["a b", "a  b\tc", "", None, "d", "e \n f g"]


@pytest.mark.parametrize("seed", [1, 2])
def test_rows_of_a_trie_built_turn_by_turn(spark, many_shards, seed):
    rows = conversations(seed, 90, 9, TEXTS[: 2 + 2 * seed])
    assert found(spark, rows) == brute(rows)


def test_nulls_ties_repeats_and_turnless(spark):
    rows = [(None, 1, "user", "lost"), (3, None, "u", "b"), (3, None, "u", "a"), (3, 1, "u", "c"), (3, 1, "u", "c"), (7, 0, None, None), (7, 0, None, None)]
    rows += [(c, 0, "u", "only") for c in range(101, 120)]  # without a base: many lose their one turn
    rows += [(0, 5, "u", "word " * 30_000), (20, 5, "u", "word " * 30_000), (20, 6, "u", "x")]
    assert found(spark, rows) == brute(rows)
    assert any(r[1] == 0 and r[7] != prefix_trie._NO_ENDS for r in found(spark, rows))


def test_a_long_conversation_lies_in_many_shards(spark, many_shards, tmp_path):
    rows = [(4, t, "u", f"t{t % 7} x") for t in range(400)] + [(5, t, "u", f"t{t % 7} x") for t in range(0, 390)] + conversations(3, 30, 5, TEXTS)
    path = str(tmp_path / "turns")
    prefix_trie.write_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), path, 0, 127)
    turns = spark.read.parquet(path)
    assert turns.where("conv = 4").select("shard").distinct().count() >= 3
    carried = prefix_trie._carried(turns)
    assert carried.where("conv = 4").count() >= 3 and carried.count() <= 2 * 8
    assert found(spark, rows) == brute(rows)


def test_many_equal_conversations(spark, many_shards):
    rows = [(c, t, "u", f"t{t}") for c in range(0, 30_000, 20) for t in range(3)]
    assert found(spark, rows) == brute(rows)
    held = spark.createDataFrame([(0, bytes(16), c, 0) for c in range(9_999)], "depth long, fp binary, conv long, length long")
    expected = hashlib.sha256(",".join(map(str, range(9_999))).encode()).hexdigest()
    assert prefix_trie._ends(held, span=100).collect()[0]["ends_sha256"] == expected


def test_turns_that_share_a_number_are_noticed(spark, many_shards, tmp_path):
    rows = conversations(5, 60, 7, TEXTS)
    path = str(tmp_path / "turns")
    prefix_trie.write_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), path, 0, 1)
    turns = spark.read.parquet(path)
    held = prefix_trie.members(turns).cache()
    assert not prefix_trie.all_equal(held, prefix_trie._top(held), turns)
    assert found(spark, rows, bits=1) == brute(rows)


def test_fingerprints_of_runs_laid_end_to_end():
    numbers = [prefix_trie.element("u", str(i), 0) for i in range(9)]

    def run(part):
        f = 0
        for n in part:
            f = prefix_trie.then(f, n, 1)
        return f

    for cut in range(10):
        assert prefix_trie.then(run(numbers[:cut]), run(numbers[cut:]), 9 - cut) == run(numbers)
    assert prefix_trie.element("a", "bc", 0) != prefix_trie.element("ab", "c", 0)


def test_empty_table(spark):
    assert found(spark, []) == []
