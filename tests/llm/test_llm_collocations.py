"""Phrases against counts made phrase by phrase."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tallyworks.llm import collocations

SCHEMA = "lang string, text string, n long, gram string, rank int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top=2000, longest=4):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                counts.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    phrases = {(lang, w): a for (lang, w), a in counts.items() if len(w) > 1 and a >= least}
    out = []
    for lang in totals:
        left = []
        for (other, w), a in phrases.items():
            if other != lang:
                continue
            score, _, l, r = min((2_000_000 * a // (counts[lang, w[:k]] + counts[lang, w[k:]]), k, counts[lang, w[:k]], counts[lang, w[k:]]) for k in range(1, len(w)))
            held = any(o == lang and len(v) > len(w) and 100 * b >= 80 * a and any(v[i : i + len(w)] == w for i in range(len(v))) for (o, v), b in phrases.items())
            if not held:
                left.append((-score, -a, " ".join(w).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(left)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def found(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1, "g", 2) for r in rows], SCHEMA).repartition(4)
    result = collocations.collocations(df, **options)
    assert result.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in result.collect())


def texts(seed, n):
    r = random.Random(seed)
    words = ["The", "of", "cat", "é", "Öl", "a-b", "x\x00y", "sat", "on", "#1"]
    fixed = ["the cat sat on", "Öl  of\tthe é", "a-b x\x00y"]
    rows = []
    for _ in range(n):
        parts = [r.choice(fixed) if r.random() < 0.3 else r.choice(words) for _ in range(r.randrange(0, 25))]
        rows.append((r.choice(["en", "fr", None]), "".join(p + r.choice([" ", " ", " ", ". ", "\n", "\t", ",", "  "]) for p in parts)))
    return rows


@pytest.mark.parametrize("seed, bits", [(1, 24), (2, 8), (3, 12)])
def test_rows_of_counts_phrase_by_phrase(spark, seed, bits):
    rows = texts(seed, 250) + [(None, None), ("en", ""), ("de", "..."), ("und", "The cat sat on")]
    expected = brute(rows, 5)
    assert len(expected) > 30
    assert found(spark, rows, least=5, table_bits=bits) == expected


def test_first_of_each_language_and_ties(spark):
    rows = [("en", f"w{i} v{i}") for i in range(60) for _ in range(3)]
    assert found(spark, rows, least=3, top=7) == brute(rows, 3, 7)


def test_long_texts_and_words(spark):
    rows = [("en", "one two three four five. " * 40_000), ("en", "z" * 300_000 + " one two"), ("en", "no end " * 50_000)]
    assert found(spark, rows) == brute(rows, 30)


def test_chunks_end_where_pieces_end():
    text = "one two, three\nfour five " * 30_000
    chunks = list(collocations._chunks(text))
    assert len(chunks) > 3 and max(map(len, chunks)) < collocations.CHUNK + 30
    assert [p.split() for c in chunks for p in re.split(r"[,\n]", c)] == [p.split() for p in re.split(r"[,\n]", text)]


def test_table_holds_every_frequent_pair(spark):
    df = spark.createDataFrame([("en", "a b c"), ("en", "a b"), ("fr", "a b"), ("en", "b, c")] * 10, "lang string, text string").repartition(5)
    table = collocations.frequent_pairs(df, least=20, bits=16)
    words = collocations._Words(["a b c", "a b"], ["en", "fr"], 16)
    assert table[words.pairs].tolist()[:2] == [True, False] and not table[words.pairs[-1]] and np.count_nonzero(table) == 1


def test_scores_beyond_64_bits(spark):
    counts = [("en", "a b", 4 * 10**18), ("en", "a", 4 * 10**18 + 3), ("en", "b", 5 * 10**18), ("en", "", 9 * 10**18)]
    df = spark.createDataFrame(counts, "lang string, gram string, n long")
    (row,) = collocations.rank_phrases(df).collect()
    assert row["score"] == 2_000_000 * 4 * 10**18 // (9 * 10**18 + 3)


def test_empty_table(spark):
    assert found(spark, []) == []
