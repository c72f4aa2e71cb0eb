"""Repeated passages: content-defined chunks by a gear rolling hash, deduplicated by digest.

A gear hash rolls over the bytes of a text: shift left, add the table value of the byte, so it depends on the last 16
bytes only. It is read at every beginning of a word, and a chunk begins at a word whose hash is the largest of the ``REACH``
words on either side. Boundaries therefore depend on nothing but the text around them: a passage is cut alike wherever it
stands, whatever was inserted before it. Chunks have 4 words or more, 7 on average, and no upper limit is needed, as ever
larger hashes soon end.

Two chunks in a row are one digest. Of each digest the first occurrence, by document and place, owns the words; at all
others they are repeated. A run of repeated chunks is removed if it has ``MIN_WORDS`` words or more. A passage of 51
words loses 6 words at most to the hash at its ends and shows a run of some 35, so that 20 leaves room for unlucky
boundaries; two texts that only share a turn of phrase have no such run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.words import Batch, batches, mix, signed, starts_of

#: Words on either side that a boundary must surpass.
REACH = 3
#: Fewest words of a run of repeated chunks that is removed.
MIN_WORDS = 20

_GEAR = mix(np.arange(5001, 5257, dtype=np.uint64)).astype(np.uint32)


def gear_hashes(data: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The rolling hash h = (h << 2) + gear[byte] after every byte, modulo 2**32, by doubling its reach; it begins anew at each start."""
    rolled = _GEAR[data]
    place = np.arange(len(data)) - np.repeat(start, np.diff(np.append(start, len(data))))
    for reach in (1, 2, 4, 8):
        shifted = np.zeros_like(rolled)
        shifted[reach:] = rolled[:-reach] << np.uint32(2 * reach)
        shifted[place < reach] = 0
        rolled = rolled + shifted
    return rolled


def _chunk_words(batch: Batch, begin: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Word numbers at which a chunk begins: the first word of every text, and the peaks of the hash."""
    # the hash at the byte before a word has seen the words before it; the word itself decides as well
    rolled = gear_hashes(batch.data, batch.start)[np.minimum(begin + 2, len(batch.data) - 1)].astype(np.int64)
    peak = np.ones(len(begin), bool)
    for step in range(1, REACH + 1):
        if step >= len(begin):
            break
        same = owner[step:] == owner[:-step]
        peak[step:] &= ~same | (rolled[step:] > rolled[:-step])
        peak[:-step] &= ~same | (rolled[:-step] > rolled[step:])
    # within REACH words of either end the text around is not known, so no boundary there
    inner = np.zeros(len(begin), bool)
    inner[REACH:-REACH or None] = (owner[REACH : -REACH or None] == owner[: -2 * REACH]) & (owner[REACH : -REACH or None] == owner[2 * REACH :]) if len(begin) > 2 * REACH else False
    first = np.concatenate([[True], owner[1:] != owner[:-1]]) if len(begin) else peak
    return np.flatnonzero(first | (peak & inner))


def _chunks(texts: list[str | None]):
    """Word bounds of the chunks of a batch of texts, with the text of each chunk and its digest."""
    batch = Batch.of(texts)
    begin, after, owner = batch.words()
    at = _chunk_words(batch, begin, owner)
    until = np.concatenate([at[1:], [len(begin)]]).astype(np.int64)
    word = batch.hashes(begin, after)
    # a chunk is its words: white space between them does not tell passages apart
    rolled = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(word) * _ladder(len(word)), dtype=np.uint64)])
    digest = mix((rolled[until] - rolled[at]) * _ladder_down(len(word) + 1)[at] + (until - at).astype(np.uint64))
    return batch, begin, after, owner, at, until, digest


_STEP = 0xD1342543DE82EF95


def _ladder(n: int) -> np.ndarray:
    up = np.full(n, _STEP, np.uint64)
    up[:1] = 1
    return np.multiply.accumulate(up)


def _ladder_down(n: int) -> np.ndarray:
    down = np.full(n, pow(_STEP, -1, 1 << 64), np.uint64)
    down[:1] = 1
    return np.multiply.accumulate(down)


def chunk_pairs(docs: DataFrame) -> DataFrame:
    """doc_id and the digests of every two chunks in a row, in order; a text of one chunk has that one's digest."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = [t if isinstance(t, str) else None for t in frame["text"]]
            for part in batches(texts):
                batch, _, _, owner, at, _, digest = _chunks(texts[part])
                bounds = starts_of(owner[at], len(batch))
                pair = signed(mix(digest[:-1] * np.uint64(3) + digest[1:])) if len(digest) else signed(digest)
                single = signed(digest)
                found = [pair[a : b - 1] if b - a > 1 else single[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
                yield pd.DataFrame({"doc_id": frame["doc_id"].iloc[part].array, "pairs": found})

    return docs.mapInPandas(run, "doc_id long, pairs array<long>")


def _without(text: str, repeated: set[int], min_words: int) -> tuple[str, list[int], list[int], int]:
    """The text without its removed runs, the code points where these begin and end, and their words."""
    batch, begin, after, _, at, until, _ = _chunks([text])
    flags = np.zeros(len(at) + 1, bool)
    for pair in repeated:
        flags[pair : pair + 2] = True
    edge = np.flatnonzero(np.diff(np.concatenate([[False], flags[:-1] if len(at) else flags[:0], [False]]).astype(np.int8)))
    data, kept, spans, last, gone = batch.data[: int(batch.end[0])], [], [], 0, 0
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
        first, beyond = int(at[a]), int(until[b - 1])
        if beyond - first >= min_words:
            low, high = int(begin[first]), int(begin[beyond]) if beyond < len(begin) else len(data)
            kept.append(data[last:low])
            spans.append((low, high))
            last, gone = high, gone + beyond - first
    kept.append(data[last:])
    lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    left = np.concatenate(kept).tobytes().decode("utf-8", "surrogatepass")
    return left, [int(lead[a]) for a, _ in spans], [int(lead[b]) for _, b in spans], gone


def with_passages_removed(docs: DataFrame, min_words: int = MIN_WORDS, name: str = "deduped") -> DataFrame:
    """All columns of ``docs`` and a struct of text, span_starts, span_ends and removed_words, as ``name``, which must be
    a new one; see ``dedupe_passages``."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(F.col("doc_id").isNotNull())
    placed = chunk_pairs(keyed).select("doc_id", F.posexplode("pairs").alias("place", "pair"))
    # aggregated where they arise, so a passage that stands everywhere shuffles one row per task
    at = F.struct("doc_id", "place")
    first = placed.groupBy("pair").agg(F.min(at).alias("owner"), F.max(at).alias("last")).where("owner < last").select("pair", "owner")
    again = placed.join(first, "pair").where(at != F.col("owner"))
    repeats = again.groupBy(F.col("doc_id").alias("repeats_in")).agg(F.collect_set("place").alias("repeated_places"))

    @F.pandas_udf("text string, span_starts array<long>, span_ends array<long>, removed_words long")
    def cut(texts: pd.Series, places: pd.Series) -> pd.DataFrame:
        rows = []
        for text, repeated in zip(texts, places, strict=True):
            if isinstance(text, str) and repeated is not None and len(repeated):
                rows.append(_without(text, set(map(int, repeated)), min_words))
            else:
                rows.append((text if isinstance(text, str) else None, [], [], 0))
        return pd.DataFrame(rows, columns=["text", "span_starts", "span_ends", "removed_words"])

    # the row out of the way of the names used here
    own = docs.select(F.struct("*").alias("own"), F.col("doc_id").cast("long").alias("key"), F.col("text").cast("string").alias("text"))
    joined = own.join(repeats, F.col("key") == F.col("repeats_in"), "left")
    found = joined.select("own", cut.asNondeterministic()("text", "repeated_places").alias("found"))
    return found.select("own.*", F.col("found").alias(name))


def dedupe_passages(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, text without repeated passages, span_starts and span_ends (code points of the text as it was), removed_words.

    The first occurrence, by doc_id and then place, stays; so one copy of a document stays whole and the others become
    empty. A passage said twice in one text stays once. Null texts stay null and empty ones empty. Rows without doc_id
    stay as they are. Rows with the same doc_id hold the same places, so none removes the other: ids are expected
    to be unique, and repeated rows are kept. Only doc_id and text are read, other columns may have any name. An empty
    table gives an empty one.
    """
    found = with_passages_removed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), min_words)
    return found.select("doc_id", "deduped.*")
