"""Phrases of two to four words that stand together more often than their parts, per language.

The words of a language form a weighted de Bruijn graph: a node is three words in a row, an edge the four words of two
nodes that overlap, its weight the number of places where they stand. Only edges are counted in the texts. From every word
one edge is read; where a piece of text ends sooner, the edge is cut short there and leads out of the graph. So the shorter
counts follow from the flow: what leaves a node over its edges, and what ends in it, is how often its three words occur; the
same step gives counts of two words and of one, and in the end the number of all words.

Two things keep the graph small, and neither changes a count that matters:

- Pairs of neighbouring words are first counted in a table of fixed size, by hash. A pair whose place in the table stays
  below the least count is rarer than that for certain, so no phrase that counts spans it, and the piece is cut there. Other
  pairs that share a place only cost rows.
- Paths are compacted before anything is scored: a phrase that passes ``ABSORBED`` per cent of its flow or more on to one phrase
  a word longer, all of it where the path has no branch, is folded into that one and looked at no further.

Each step of the flow is one aggregation by the words before the last, with sums made before the shuffle, so a frequent
word or pair never brings its edges to one task.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.llm.words import Batch, batches, mix
from tallyworks.session import broadcast_if_small, cut_lineage

LONGEST = 4
LEAST = 30
TOP = 2000
ABSORBED = 80
SCALE = 2_000_000
#: Places of the table of pair counts, as a power of two. It is this large for any corpus: 2 MB when it is broadcast.
TABLE_BITS = 24
#: Parts the table travels in, tasks whose parts are added up together, and words whose edges are written at once.
TABLE_PARTS = 256
TASKS_TOGETHER = 1000
WORDS_AT_ONCE = 1 << 16
#: Edges that a task collects before it adds up equal ones.
EDGES_HELD = 1 << 20
#: Characters from which a text is cut, at the end of a piece.
CHUNK = 1 << 17
#: Lots in which a language's phrases are first ranked.
LOTS = 64

_PIECE_END = np.zeros(256, bool)
_PIECE_END[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_BETWEEN = _PIECE_END.copy()
_BETWEEN[[0x20, 0x09]] = True
_END = re.compile(r"[.,;:!?\x0A-\x0D]")
_FACTOR = np.uint64(0xD6E8FEB86659FD93)


def _chunks(text: str | None) -> Iterator[str]:
    """A text in parts that begin and end with pieces; longer than ``CHUNK`` only as far as a piece goes on."""
    text, at = text or "", 0
    while len(text) - at > CHUNK and (end := _END.search(text, at + CHUNK)):
        yield text[at : end.start()]
        at = end.end()
    yield text[at:]


class _Words:
    """The words of a batch of texts, with what tells whether neighbours belong to one piece."""

    def __init__(self, texts: list[str], langs: list[str], bits: int):
        self.batch = Batch.of(texts, lower=True)
        data = self.batch.data
        edge = np.flatnonzero(np.diff(np.concatenate([[False], ~_BETWEEN[data], [False]]).astype(np.int8)))
        self.first, self.after = edge[::2], edge[1::2]
        self.text = np.searchsorted(self.batch.start, self.first, "right") - 1
        piece = np.cumsum(_PIECE_END[data])[self.first]  # the newline after each text ends a piece
        self.joined = piece[1:] == piece[:-1]
        salt = {lang: zlib.crc32(lang.encode("utf-8", "surrogatepass")) for lang in set(langs)}
        of_text = np.array([salt[lang] for lang in langs], np.uint64)
        hashes = self.batch.hashes(self.first, self.after)
        self.pairs = (mix(hashes[:-1] * _FACTOR + hashes[1:] + of_text[self.text[:-1]]) >> np.uint64(64 - bits)).astype(np.int64)

    def edges(self, frequent: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, pa.Array]]:
        """Text number and words, one blank between them, of the edge that begins at each word."""
        n = len(self.first)
        last = np.flatnonzero(np.concatenate([~(self.joined & frequent[self.pairs]), [True]]))  # a word that ends its piece
        until = np.minimum(last[np.searchsorted(last, np.arange(n))], np.arange(n) + longest - 1)
        size = self.after - self.first
        at = np.concatenate([[0], np.cumsum(size + 1)])
        place = np.arange(at[-1]) + np.repeat(self.first - at[:-1], size + 1)
        blanked = self.batch.data[place]
        blanked[at[1:] - 1] = 0x20
        for begin in range(0, n, WORDS_AT_ONCE):
            span = slice(begin, begin + WORDS_AT_ONCE)
            start, end = at[:-1][span], at[1:][until[span]] - 1
            offsets = np.concatenate([[0], np.cumsum(end - start)])
            chars = blanked[np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], end - start)]
            yield self.text[span], pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(chars)).cast(pa.string())


def _word_batches(tables: Iterator[pa.RecordBatch], bits: int) -> Iterator[tuple[_Words, list[str]]]:
    for table in tables:
        texts, langs = [], []
        for text, lang in zip(table["text"].to_pylist(), table["lang"].to_pylist(), strict=True):
            for chunk in _chunks(text):
                texts.append(chunk)
                langs.append(lang)
        for part in batches(texts):
            words = _Words(texts[part], langs[part], bits)
            if len(words.first):
                yield words, langs[part]


def frequent_pairs(texts: DataFrame, least: int = LEAST, bits: int = TABLE_BITS) -> np.ndarray:
    """For each place of the table whether the pairs of neighbouring words that fall there occur ``least`` times or more together.

    Counts stop at ``least``. Every task fills a table of its own; tables are added in parts, first those of ``TASKS_TOGETHER``
    tasks, then their sums, and only the bits reach the driver.
    """
    kind, width = np.min_scalar_type(least), (1 << bits) // TABLE_PARTS

    def count(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(1 << bits, kind)
        for words, _ in _word_batches(tables, bits):
            places, n = np.unique(words.pairs[words.joined], return_counts=True)
            found[places] = np.minimum(found[places] + n, least)
        lot = TaskContext.get().partitionId() // TASKS_TOGETHER
        for part, counts in enumerate(found.reshape(TABLE_PARTS, width)):
            if counts.any():
                yield pa.RecordBatch.from_pydict({"part": [part], "lot": [lot], "counts": [counts.tobytes()]}, schema=pa.schema([("part", pa.int32()), ("lot", pa.int32()), ("counts", pa.binary())]))

    def total(frame: pd.DataFrame) -> np.ndarray:
        summed = np.zeros(width, np.int64)
        for counts in frame["counts"]:
            summed += np.frombuffer(counts, kind)
        return np.minimum(summed, least)

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": frame["part"].iloc[:1], "counts": [total(frame).astype(kind).tobytes()]})

    def flag(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": frame["part"].iloc[:1], "bits": [np.packbits(total(frame) >= least).tobytes()]})

    counted = texts.mapInArrow(count, "part int, lot int, counts binary")
    lots = counted.groupBy("part", "lot").applyInPandas(add, "part int, counts binary")
    table = np.zeros((TABLE_PARTS, width), bool)
    for row in lots.groupBy("part").applyInPandas(flag, "part int, bits binary").collect():
        table[row["part"]] = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=width).astype(bool)
    return table.reshape(-1)


def edges(texts: DataFrame, table: Broadcast, longest: int = LONGEST, bits: int = TABLE_BITS) -> DataFrame:
    """lang, gram and n: the edges of the graph, fewer than ``longest`` words where a piece ends, added up within a task now and then."""
    schema = pa.schema([("lang", pa.string()), ("gram", pa.string()), ("n", pa.int64())])

    def added(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summed = pa.Table.from_batches(held).group_by(["lang", "gram"], use_threads=False).aggregate([([], "count_all")])
        yield from summed.select(["lang", "gram", "count_all"]).rename_columns(schema.names).cast(schema).to_batches(max_chunksize=1 << 16)

    def read(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = np.unpackbits(np.frombuffer(table.value, np.uint8)).astype(bool)
        held, rows = [], 0
        for words, langs in _word_batches(tables, bits):
            of_text = pa.array(langs, pa.string())
            for text, grams in words.edges(frequent, longest):
                held.append(pa.RecordBatch.from_arrays([of_text.take(pa.array(text)), grams], names=["lang", "gram"]))
                rows += len(grams)
                if rows >= EDGES_HELD:
                    yield from added(held)
                    held, rows = [], 0
        if held:
            yield from added(held)

    return texts.mapInArrow(read, "lang string, gram string, n long")


def flow_counts(found: DataFrame, longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """lang, gram and n of all phrases up to ``longest`` words that occur ``least`` times, and under the empty gram the number of words.

    The flow of ``edges`` goes down by one word at a time. Phrases that are counted go along unchanged.
    """
    level = found.groupBy("lang", "gram").agg(F.sum("n").alias("n")).withColumn("counted", F.lit(False))
    for words in range(longest - 1, -1, -1):
        head = F.substring_index("gram", " ", words)
        whole = (head != F.col("gram")) & (F.col("n") >= least)  # fewer words end there and only flow on
        on = F.when(~F.col("counted"), F.struct(head.alias("gram"), "n", F.lit(False).alias("counted")))
        kept = F.when(F.col("counted") | whole, F.struct("gram", "n", F.lit(True).alias("counted")))
        level = level.select("lang", F.inline(F.array_compact(F.array(on, kept))))
        level = level.groupBy("lang", "gram", "counted").agg(F.sum("n").alias("n"))
    return level.select("lang", "gram", "n")


def _wide(number: Column) -> Column:
    """Room for products beyond 64 bits."""
    return number.cast("decimal(19,0)")


def rank_phrases(counts: DataFrame, top: int = TOP, least: int = LEAST, absorbed: int = ABSORBED) -> DataFrame:
    """The first ``top`` phrases of every language, from ``flow_counts``."""
    counts = cut_lineage(counts)
    size = F.size(F.split("gram", " "))
    phrases = counts.where(F.col("gram").contains(" ") & (F.col("n") >= least)).select("lang", F.col("gram").alias("phrase"), F.col("n").alias("a"), size.alias("size"))

    # a phrase lies in one two words longer only by way of one that is one word longer and at least as frequent
    shorter = F.array(F.expr("substring_index(phrase, ' ', size - 1)"), F.expr("substring_index(phrase, ' ', 1 - size)"))
    heaviest = phrases.where("size > 2").select("lang", F.explode(shorter).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = phrases.join(heaviest, ["lang", "phrase"], "left")
    left = left.where(F.col("longer").isNull() | (_wide(F.col("longer")) * 100 < _wide(F.col("a")) * absorbed)).drop("longer")

    cuts = left.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("cut"))
    cuts = cuts.select("*", F.expr("substring_index(phrase, ' ', cut)").alias("left"), F.expr("substring_index(phrase, ' ', cut - size)").alias("right"))
    lefts = counts.select("lang", F.col("gram").alias("left"), F.col("n").alias("l"))
    rights = counts.select("lang", F.col("gram").alias("right"), F.col("n").alias("r"))
    met = cuts.join(lefts, ["lang", "left"]).join(rights, ["lang", "right"])
    score = F.expr(f"cast({SCALE} as decimal(7,0)) * cast(a as decimal(19,0)) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))")
    scored = met.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("best"))

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rows = scored.select("lang", "phrase", "a", "best.l", "best.r", "best.score", F.pmod(F.xxhash64("phrase"), F.lit(LOTS)).alias("lot"))
    first = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "lot").orderBy(*order))).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    totals = counts.where("gram = ''").select("lang", "n")
    return ranked.join(broadcast_if_small(totals), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations(docs: DataFrame, *, top: int = TOP, least: int = LEAST, longest: int = LONGEST, absorbed: int = ABSORBED, table_bits: int = TABLE_BITS) -> DataFrame:
    """Per language the ``top`` phrases of 2 to ``longest`` words: lang, rank, phrase, a, l, r, n, score.

    a is how often the phrase occurs, l and r how often the parts of its weakest cut do, n the number of words of the language.
    A null lang is ``und``, a null text has no words. Only lang and text are read, other columns may have any name, and rows that
    repeat count each time. An empty table gives no rows. Equal scores are told apart by a, then by the bytes of the phrase.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    table = spark.sparkContext.broadcast(np.packbits(frequent_pairs(texts, least, table_bits)).tobytes())
    return rank_phrases(flow_counts(edges(texts, table, longest, table_bits), longest, least), top, least, absorbed)
