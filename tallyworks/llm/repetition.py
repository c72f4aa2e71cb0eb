"""Repetition within a text, by suffix array and longest common prefixes.

A text is its sequence of words. The suffixes of many texts are sorted together by prefix doubling: rank by one
word, then by two, four, eight ... until all ranks differ. The ranks of each doubling are kept, and the common prefix of
two neighbours is read off them from the longest doubling down. The intervals of that array are the maximal
repeated word strings: the suffix at place ``r`` begins a repeat of max(lcp[r], lcp[r + 1]) words, and no longer one. The union
of these spans, over repeats of at least ``min_words``, is the repeated part of the text.

First words are ranked by text before word, so suffixes of different texts never share a prefix.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.words import Batch, batches, starts_of

#: Fewest words of a repeat that counts.
MIN_WORDS = 5
#: A text is rejected if more than this part of its words lies in repeats ...
MAX_COVERED_PERCENT = 30
#: ... or if a repeat is longer than this.
MAX_REPEAT_WORDS = 100

MIN_DOC_WORDS = 50
MAX_WINDOW_PERCENT = 50

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def suffix_array(first: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Sorted suffixes of a sequence of ranks, and the ranks by 1, 2, 4, 8 ... elements that led to them."""
    n = len(first)
    levels, step = [first], 1
    while True:
        rank = levels[-1]
        beyond = np.zeros(n, np.int64)
        beyond[: n - step] = rank[step:] + 1
        key = rank * (n + 1) + beyond
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        fresh = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        following = np.empty(n, np.int64)
        following[order] = fresh
        levels.append(following)
        if n == 0 or fresh[-1] == n - 1:
            return order, levels
        step *= 2


def common_prefixes(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """lcp[r]: elements that the suffixes at places r - 1 and r share; 0 at both ends."""
    n = len(order)
    lcp = np.zeros(n + 1, np.int64)
    left, right = order[:-1].copy(), order[1:].copy()
    shared = np.zeros(max(n - 1, 0), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        step = 1 << level
        padded = np.concatenate([levels[level], -np.ones(1, np.int64)])
        fits = (left + step <= n) & (right + step <= n)
        same = fits & (padded[np.minimum(left, n)] == padded[np.minimum(right, n)])
        left += step * same
        right += step * same
        shared += step * same
    lcp[1:n] = shared
    return lcp


def longest_repeats(first: np.ndarray) -> np.ndarray:
    """For each place of a sequence of ranks, the length of the longest repeat that begins there."""
    order, levels = suffix_array(first)
    lcp = common_prefixes(order, levels)
    longest = np.zeros(len(first), np.int64)
    longest[order] = np.maximum(lcp[:-1], lcp[1:])
    return longest


def _ranks(owner: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Equal ranks for equal words of the same text; texts in order."""
    order = np.lexsort((hashes, owner))
    fresh = (np.diff(hashes[order]) != 0) | (np.diff(owner[order]) != 0)
    rank = np.empty(len(hashes), np.int64)
    rank[order] = np.concatenate([[0], np.cumsum(fresh)])[: len(hashes)]
    return rank


def repeated(texts: list[str | None], min_words: int = MIN_WORDS) -> list[list[tuple[int, int]]]:
    """The spans (first word, word after the last) that maximal repeats of ``min_words`` or more cover, by text."""
    batch = Batch.of(texts)
    begin, after, owner = batch.words()
    mask, _ = _covered(_ranks(owner, batch.hashes(begin, after)), min_words)
    bounds = starts_of(owner, len(batch))
    spans = []
    for a, b in zip(bounds, bounds[1:], strict=False):
        edge = np.flatnonzero(np.diff(np.concatenate([[0], mask[a:b].astype(np.int8), [0]])))
        spans.append(list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)))
    return spans


def _covered(first: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    longest = longest_repeats(first) if len(first) else np.empty(0, np.int64)
    at = np.flatnonzero(longest >= min_words)
    change = np.zeros(len(first) + 1, np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + longest[at], -1)
    return np.cumsum(change)[:-1] > 0, longest


def _measure(texts: list[str | None], min_words: int) -> dict[str, np.ndarray]:
    batch = Batch.of(texts)
    n = len(batch)
    prefix = batch.prefix()
    begin, after, owner = batch.words()
    hashes = batch.hashes(begin, after, prefix)
    bounds = starts_of(owner, n)
    per_text = lambda flags: np.bincount(owner, weights=flags, minlength=n).astype(np.int64)
    found = {"n_words": np.diff(bounds)}
    lead = (batch.data & 0xC0) != 0x80  # first byte of each code point
    found["word_chars"] = per_text(batch.count(lead, begin, after))
    found["n_symbols"] = batch.count(_SYMBOL[batch.data], batch.start, batch.end)

    # lines: cut at every newline of a text and at its end
    line_end = np.flatnonzero(batch.data == 0x0A)
    line_begin = np.concatenate([[0], line_end[:-1] + 1]) if len(line_end) else line_end
    has_word = np.searchsorted(begin, line_end) > np.searchsorted(begin, line_begin)
    line_begin, line_end = line_begin[has_word], line_end[has_word]
    line_owner = np.searchsorted(batch.start, line_begin, "right") - 1
    line_rank = _ranks(line_owner, batch.hashes(line_begin, line_end, prefix))
    _, first_seen = np.unique(line_rank, return_index=True)
    found["n_dup_lines"] = np.bincount(line_owner, minlength=n) - np.bincount(line_owner[first_seen], minlength=n)

    rank = _ranks(owner, hashes)
    mask, longest = _covered(rank, 3)
    found["n_repeat_words"] = per_text(mask)
    at = longest >= min_words
    change = np.zeros(len(rank) + 1, np.int64)
    np.add.at(change, np.flatnonzero(at), 1)
    np.add.at(change, np.flatnonzero(at) + longest[at], -1)
    found["n_covered_words"] = per_text(np.cumsum(change)[:-1] > 0)
    found["longest_repeat"] = np.zeros(n, np.int64)
    np.maximum.at(found["longest_repeat"], owner, longest)
    return found


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered_words", "longest_repeat")


def measure(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id and the counts that the rules need, for every row and its whole text.

    n_repeat_words are the words in 3-word windows found twice or more: those covered by repeats of three words.
    n_covered_words are those covered by maximal repeats of ``min_words``; longest_repeat is 0 in a text without.
    Null and empty texts have only zeros, null ids stay, repeated rows stay repeated, an empty table gives an empty one.
    Only doc_id and text are read, so other columns may have any name.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = [t if isinstance(t, str) else None for t in frame["text"]]
            for part in batches(texts):
                yield pd.DataFrame({"doc_id": frame["doc_id"].iloc[part].array, **_measure(texts[part], min_words)})

    schema = "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInPandas(run, schema)


def judge(
    docs: DataFrame,
    min_words: int = MIN_WORDS,
    max_covered_percent: int = MAX_COVERED_PERCENT,
    max_repeat_words: int = MAX_REPEAT_WORDS,
) -> DataFrame:
    """The measures with base_failed (fewer than 50 words, or over half of them in repeated 3-word windows) and kept.

    A text is kept if the base does not fail, at most ``max_covered_percent`` of its words lie in repeats and
    no repeat is longer than ``max_repeat_words``. Comparisons are between whole numbers.
    """
    base = (F.col("n_words") < MIN_DOC_WORDS) | (100 * F.col("n_repeat_words") > MAX_WINDOW_PERCENT * F.col("n_words"))
    by_method = (100 * F.col("n_covered_words") <= max_covered_percent * F.col("n_words")) & (F.col("longest_repeat") <= max_repeat_words)
    return measure(docs, min_words).withColumn("base_failed", base).withColumn("kept", ~base & by_method)
