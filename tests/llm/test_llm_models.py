"""Classifiers by held-out accuracy, vector search by recall, and the pipeline, on small tables."""

import math
import random
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from tallyworks.llm import ann_codes, quality_lines, queries, toxicity, url_trees
from tallyworks.session import scratch_path

SF_DIR = "/root/testdata/sf0.01"
RULES = queries.URL_RULES


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet"), spark.read.parquet(f"{SF_DIR}/labels.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(0, None, 1.0, "a"), (1, "", 2.0, "b"), (None, "some words\nand more", 3.0, "c"), (2, "x" * 60_000, 4.0, "d"), (2, "x" * 60_000, 4.0, "d"), (3, "\n\n \n", 5.0, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, score double, features string")


def correct(scored, labels, target):
    rows = scored.where("held_out").join(labels, "doc_id").select("predicted", target).collect()
    return np.mean([p == t for p, t in rows]), np.mean([t for _, t in rows])


def test_line_quality_on_held_out_documents(tables, odd):
    docs, labels = tables
    model = quality_lines.train(docs, labels)
    scored = quality_lines.classify(docs, model)
    assert scored.count() == docs.count()
    accuracy, share = correct(scored, labels, "quality")
    assert accuracy >= 0.95 and share < 0.95
    for row in scored.limit(50).collect():
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 4 == 2)
    rows = quality_lines.classify(odd, model).collect()
    assert len(rows) == 6 and all(0 <= r.score <= 1 for r in rows) and rows[0].score == rows[1].score == rows[5].score
    assert quality_lines.classify(odd.limit(0), model).count() == 0
    assert {r.score for r in quality_lines.classify(odd, quality_lines.train(docs, labels.limit(0))).collect()} == {0.5}


def test_marginals_against_enumeration():
    random_ = np.random.default_rng(4)
    scores, follow = random_.normal(size=9), random_.normal(size=(2, 2))
    owner = np.array([0, 0, 0, 0, 1, 3, 3, 3, 3])
    good, pairs = quality_lines.forward_backward(scores, owner, 4, follow)
    expected, counted = [], np.zeros((2, 2))
    for text in (0, 1, 3):
        own = scores[owner == text]
        paths = [[(m >> i) & 1 for i in range(len(own))] for m in range(2 ** len(own))]
        weights = np.array([math.exp(sum(s * y for s, y in zip(own, p, strict=True)) + sum(follow[a, b] for a, b in zip(p, p[1:], strict=False))) for p in paths])
        weights /= weights.sum()
        expected += list(weights @ np.array(paths))
        for w, p in zip(weights, paths, strict=True):
            for a, b in zip(p, p[1:], strict=False):
                counted[a, b] += w
    assert np.allclose(good, expected) and np.allclose(pairs, counted)


def test_toxicity_on_held_out_documents(spark, odd):
    """At sf0.1: the lexicon of invented insults needs more toxic documents than the thirty of the smaller tables."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    rows = toxicity.score(docs.join(labels, "doc_id", "left_semi"), model).where("held_out").join(labels, "doc_id").select("predicted", "toxic").collect()
    toxic, clean = [p for p, t in rows if t], [p for p, t in rows if not t]
    assert np.mean(toxic) >= 0.85 and np.mean(clean) <= 0.02
    rows = toxicity.score(odd, model).collect()
    assert len(rows) == 6 and all(0 <= r.score <= 1 for r in rows) and rows[0].score == rows[1].score
    assert toxicity.score(odd.limit(0), model).count() == 0
    assert {r.score for r in toxicity.score(odd, toxicity.train(docs, labels.limit(0))).collect()} == {0.0}
    assert toxicity.with_score(odd, model, name="tox").columns == [*odd.columns, "tox"]


def test_toxic_features():
    lexicon = toxicity.Lexicon({"blorg*": 2.0, "fleem": 3.0})
    names = toxicity.FEATURES
    rows = toxicity.text_features(["you are a fleem", "BLORGER!! FLEEM!!", None, "a fl33m, sooo", "all is well"], lexicon, {})
    at = {n: rows[:, i] for i, n in enumerate(names)}
    assert at["hit_rate"].tolist() == [25, 100, 0, 0, 0] and at["near_second"].tolist() == [0.25, 0, 0, 0, 0]
    assert at["shouted"].tolist() == [0, 10 / 12, 0, 0, 0] and at["exclaims"][1] > 0 and at["capitals"][1] == 1
    assert at["obfuscated_hits"].tolist() == [0, 0, 0, 1, 0] and at["drawn_out"][3] > 0 and not rows[2].any()


def brute_url(url):
    rest = url.partition("://")[2] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = (None, None)
    for verdict, rule in RULES:
        name, _, start = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start) and len(rule) > len(best[0] or ""):
            best = (rule, verdict)
    return host, path, *best


def test_url_rules_and_verdicts(spark):
    urls = ["http://A.Example.ORG/es/1?x=1", "https://example.org/en/12#t", "http://org", "http://org/", "x.com/fr/1", None, "", "ftp://com/de/x", "http://notorg/", "http://h.com/fr", "http://É.com/fr/?q"]
    urls += ["http://a/b://c", "http://x.net/" + "9" * 5000, "://", "http://x.net?a=1&b=2"]
    pages = spark.createDataFrame([(i, u, "r", i) for i, u in enumerate(urls)] + [(None, urls[0], "r", 0)], "page_id long, url string, rule string, n int")
    rows = url_trees.judge(pages, RULES).collect()
    assert len(rows) == len(urls) + 1
    for row in rows:
        host, path, rule, verdict = brute_url(urls[row.page_id or 0])
        assert (row.host, row.path, row.rule) == (host, path, rule)
        assert row.verdict == verdict if rule else row.verdict in ("allow", "block")
    assert url_trees.judge(pages.limit(0), RULES).count() == 0


def test_url_trees_learn_from_labels(spark):
    random_ = random.Random(3)
    def url(bad):
        host = "".join(random_.choice("abcdefgh") for _ in range(8)) + ("-" + str(random_.randrange(10**6)) if bad else "")
        return f"http://{host}.example.net/" + ("/".join("x" * 3 for _ in range(5)) + "?a=1&b=2&c=3" if bad else "page")
    labelled = [(url(i % 2), i % 2) for i in range(400)]
    pages = [(i, url(i % 2)) for i in range(200)]
    judged = url_trees.judge(spark.createDataFrame(pages, "page_id long, url string"), [], spark.createDataFrame(labelled, "url string, blocked int"))
    assert np.mean([(r.verdict == "block") == (r.page_id % 2 == 1) for r in judged.collect()]) > 0.95
    plan = judged._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_search_recall_and_scores(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = ann_codes.search(table, table.vec_id % 50 == 0).collect()
    local = {r.vec_id: np.array(r.embedding, float) for r in table.collect()}
    ids, unit = np.array(list(local)), np.array([v / np.linalg.norm(v) for v in local.values()])
    hits = 0
    for query in [i for i in local if i % 50 == 0]:
        found = sorted((r.rank, r.vec_id, r.score) for r in rows if r.query_id == query)
        assert [r for r, _, _ in found] == [1, 2, 3, 4, 5]
        assert all(s == pytest.approx(unit[np.flatnonzero(ids == i)[0]] @ unit[np.flatnonzero(ids == query)[0]]) for _, i, s in found)
        near = unit @ unit[np.flatnonzero(ids == query)[0]]
        near[ids == query] = -2
        hits += len({i for _, i, _ in found} & set(ids[np.lexsort((ids, -near))[:5]].tolist()))
    assert hits >= 0.9 * len(rows)


def test_index_finds_all_codes_in_the_radius():
    random_ = np.random.default_rng(6)
    packed = random_.integers(0, 256, (2000, 16), dtype=np.uint8)
    index = ann_codes.Index(packed)
    for radius in (0, 3, 17, 50, 128):
        code = packed[5] ^ (random_.random(16) < 0.3).astype(np.uint8)
        apart = np.unpackbits(packed ^ code, axis=1).sum(axis=1)
        assert index.within(code, radius).tolist() == np.flatnonzero(apart <= radius).tolist()


def test_search_of_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [3.0, 0.0]), (3, [0.0, 1.0]), (4, None), (5, [0.0, 0.0]), (6, [float("nan"), 1.0]), (7, [None, 1.0]), (8, [float("inf"), 1.0]), (9, []), (None, [1.0, 1.0]), (1, [2.0, 0.0]), (50, [5.0, 0.0])]
    table = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, rank int")
    found = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in ann_codes.search(table, table.vec_id % 50 == 0).collect())
    assert [f[:3] for f in found] == [(0, 1, 1), (0, 2, 2), (0, 3, 50), (0, 4, 3), (50, 1, 0), (50, 2, 1), (50, 3, 2), (50, 4, 3)]
    assert [f[3] for f in found[:4]] == [1.0, 1.0, 1.0, 0.0]
    assert ann_codes.search(table.limit(0), table.vec_id % 50 == 0).count() == 0


def test_pipeline_stages_take_effect(spark):
    columns = spark.read.parquet(f"{SF_DIR}/documents.parquet").columns
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    seen = {"start": docs.count()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = scratch_path(spark, "stage")
        stage(spark, docs, SF_DIR).write.parquet(path)
        after = spark.read.parquet(path)
        assert after.columns == columns and after.join(docs, "doc_id", "left_anti").isEmpty()
        docs, seen[name] = after, after.count()
    assert seen["start"] > seen["toxicity"] > seen["quality classifier"] > seen["near-dedup"] >= seen["substring dedup"] > 0.5 * seen["start"]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.select("doc_id").collect()}
