"""Stages of the pipeline on small tables."""

import random
import re

import corpus_pipeline
import pytest

from tallyworks.llm import near_dups

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(n, random_):
    return " ".join(f"word{random_.randrange(5000)}" for _ in range(n))


def block_replaced(text, at, n):
    words = text.split(" ")
    words[at : at + n] = [f"other{at}x{i}" for i in range(n)]
    return " ".join(words)


def scattered(text, n):
    words = text.split(" ")
    for i in range(n):
        words[20 + i * (len(words) - 40) // n] = f"new{i}"
    return " ".join(words)


def brute_kept(texts, words, percent):
    sets = {i: {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} for i, w in ((i, WORD.findall(t.lower())) for i, t in texts.items())}
    label = {i: i for i in texts}
    for _ in texts:
        for a in texts:
            for b in texts:
                shared = len(sets[a] & sets[b])
                if shared and 100 * shared >= percent * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
    return {i for i in texts if label[i] == i}


def test_near_copies_of_the_stage_are_those_of_brute_force(spark):
    random_ = random.Random(8)
    base, edits = prose(200, random_), prose(200, random_)
    texts = {0: base, 1: block_replaced(base, 60, 16), 2: edits, 3: scattered(edits, 5)}
    for i in range(4, 60):
        source = texts[random_.randrange(i)] if i % 4 else prose(random_.randrange(60, 250), random_)
        texts[i] = (block_replaced(source, random_.randrange(40), random_.randrange(1, 40)) if i % 3 else scattered(source, random_.randrange(1, 8))) if i % 4 else source
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts.items()], COLUMNS)
    kept = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()}
    assert 1 not in kept and 3 in kept
    assert kept == brute_kept(texts, 5, 80) != brute_kept(texts, 3, 85)


def test_signatures_follow_the_similarity(spark):
    assert near_dups.lost_share(85, 8) < near_dups.LOST and near_dups.lost_share(80, 12) < near_dups.LOST
    docs = spark.createDataFrame([], COLUMNS)
    assert near_dups.near_duplicates(docs, words=5, percent=80, chunks=12).count() == 0
    with pytest.raises(ValueError):
        near_dups.near_duplicates(docs, words=5, percent=79, chunks=12)


@pytest.mark.parametrize("labels", [[], [(i, 1, 0) for i in range(40)]])
def test_without_a_model_the_classifier_stages_keep_all(spark, tmp_path, labels):
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame([(i, f"A clean text, number {i}.", "en", "s", 20) for i in range(40)], COLUMNS)
    for stage in (corpus_pipeline.drop_toxic, corpus_pipeline.drop_bad):
        assert sorted(stage(spark, docs, str(tmp_path)).collect()) == sorted(docs.collect())
