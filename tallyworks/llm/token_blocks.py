"""Token ids of all documents in binary files of patched frame-of-reference blocks.

A file holds segments, one after the other; a segment holds whole documents, some millions of ids. All numbers are little-endian:

    header   magic, bytes of the segment (u64), shard (u32), ids of the shard before this segment (u64), ids (u64),
             documents (u32), blocks (u32), ids of a block (u32)
    index    per document its id (i64), whether that is null (u8) and its number of ids (u64);
             per block the smallest id (u32), width (u8), number of exceptions (u16), and where it starts (u64, one more at the end)
    blocks   ids less the smallest one, the low ``width`` bits of each packed; then the places (u16) and the high bits (u32) of
             those that need more, the exceptions
    end      one newline

The width of a block is that of the ``PERCENTILE``-th percentile of its values, so a few large ids do not widen the others. In
a block 32 lanes lie side by side: id ``32 * k + lane`` is the k-th value of its lane. Any run of ids is read by decoding the
blocks it touches; ``ids_at`` does so by the index of block starts.

Files are written by Spark's text writer, the bytes of a segment being one record. So a task that is lost and run again leaves
one copy, and any store that Spark writes to will do.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm.packing import encoder
from tallyworks.operators.ranges import totals_before
from tallyworks.session import broadcast_if_small, cut_lineage, scratch_path

END_ID = 0
#: Ids of a block; a multiple of 32.
BLOCK = 1024
#: Per cent of a block's values that its width is to hold.
PERCENTILE = 98
#: A segment is closed with the document that reaches so many ids.
SEGMENT_IDS = 1 << 21
#: Segments of a file, which bounds what a reader holds at once.
SEGMENTS_PER_FILE = 4
#: Bytes of text that a task should encode.
SHARD_BYTES = 64 * 1024 * 1024

_MAGIC = b"IDBLOCK1"
_HEADER = struct.Struct("<8sQIQQIII")
_LANES = 32


def _bit_length(values: np.ndarray) -> np.ndarray:
    return np.ceil(np.log2(values.astype(np.float64) + 1)).astype(np.int64)


def _packed(values: np.ndarray, width: int) -> np.ndarray:
    """Low bits of (blocks, ids) values as (blocks, width * lanes) words."""
    steps = values.shape[1] // _LANES
    lanes = values.reshape(len(values), steps, _LANES) & np.uint32((1 << width) - 1)
    words = np.zeros((len(values), -(-steps * width // 32), _LANES), np.uint32)
    for k in range(steps):
        word, shift = divmod(k * width, 32)
        words[:, word] |= lanes[:, k] << np.uint32(shift)
        if shift + width > 32:
            words[:, word + 1] |= lanes[:, k] >> np.uint32(32 - shift)
    return words.reshape(len(values), -1)


def _unpacked(words: np.ndarray, width: int, block: int) -> np.ndarray:
    steps = block // _LANES
    words = words.reshape(len(words), -1, _LANES)
    out = np.zeros((len(words), steps, _LANES), np.uint32)
    mask = np.uint32((1 << width) - 1)
    for k in range(steps) if width else ():
        word, shift = divmod(k * width, 32)
        out[:, k] = words[:, word] >> np.uint32(shift)
        if shift + width > 32:
            out[:, k] |= words[:, word + 1] << np.uint32(32 - shift)
        out[:, k] &= mask
    return out.reshape(len(words), block)


def _packed_bytes(width: int, block: int) -> int:
    return -(-(block // _LANES) * width // 32) * _LANES * 4


def encode_segment(
    ids: np.ndarray, doc_ids: list[int | None], sizes: list[int], shard: int = 0, first: int = 0, *, block: int = BLOCK, percentile: int = PERCENTILE
) -> bytes:
    """The bytes of one segment: ids of the documents end to end, with their doc_ids and numbers of ids."""
    if block % _LANES or not 0 < block <= 1 << 16:
        raise ValueError("a block holds a multiple of 32 ids, 65536 at most")
    ids = np.asarray(ids, np.uint32)
    n_blocks = -(-len(ids) // block)
    padded = np.concatenate([ids, np.repeat(ids[-1:], n_blocks * block - len(ids))]).reshape(n_blocks, block)
    low = padded.min(axis=1) if n_blocks else np.zeros(0, np.uint32)
    values = padded - low[:, None]
    place = min(block - 1, -(-percentile * block // 100) - 1)
    width = _bit_length(np.partition(values, place, axis=1)[:, place]) if n_blocks else np.zeros(0, np.int64)
    over = values.astype(np.uint64) >> width[:, None].astype(np.uint64)
    row, column = np.nonzero(over)
    outliers = np.bincount(row, minlength=n_blocks)
    if len(row) and outliers.max() >= 1 << 16:
        raise ValueError("too many exceptions in a block")
    at = np.concatenate([[0], np.cumsum(outliers)])
    places, high = column.astype("<u2"), over[row, column].astype("<u4")
    words: list[bytes] = [b""] * n_blocks
    for w in np.unique(width).tolist():
        if w:
            chosen = np.flatnonzero(width == w)
            for b, packed in zip(chosen.tolist(), _packed(values[chosen], w).astype("<u4"), strict=True):
                words[b] = packed.tobytes()
    body = [words[b] + places[at[b] : at[b + 1]].tobytes() + high[at[b] : at[b + 1]].tobytes() for b in range(n_blocks)]
    starts = np.concatenate([[0], np.cumsum([len(x) for x in body])]).astype("<u8")
    index = [
        np.array([i or 0 for i in doc_ids], "<i8").tobytes(),
        np.array([i is None for i in doc_ids], np.uint8).tobytes(),
        np.array(sizes, "<u8").tobytes(),
        low.astype("<u4").tobytes(),
        width.astype(np.uint8).tobytes(),
        outliers.astype("<u2").tobytes(),
        starts.tobytes(),
    ]
    rest = b"".join(index + body)
    return _HEADER.pack(_MAGIC, _HEADER.size + len(rest), shard, first, len(ids), len(doc_ids), n_blocks, block) + rest


class Segment:
    """A segment as it lies in a file; nothing but the index is decoded until ids are asked for."""

    def __init__(self, data: bytes | memoryview):
        magic, self.size, self.shard, self.first, self.n_ids, n_docs, n_blocks, self.block = _HEADER.unpack_from(data)
        if magic != _MAGIC:
            raise ValueError("not a segment of token ids")
        self.data, self._at = data, _HEADER.size
        doc_ids, null, self.sizes = self._take("<i8", n_docs), self._take("u1", n_docs), self._take("<u8", n_docs).astype(np.int64)
        self.doc_ids = [None if gone else i for i, gone in zip(doc_ids.tolist(), null.tolist(), strict=True)]
        self.low, self.width, self.outliers = self._take("<u4", n_blocks), self._take("u1", n_blocks), self._take("<u2", n_blocks)
        self.starts = self._take("<u8", n_blocks + 1).astype(np.int64)

    def _take(self, kind: str, n: int) -> np.ndarray:
        found = np.frombuffer(self.data, kind, n, self._at)
        self._at += found.nbytes
        return found

    def blocks(self, begin: int, end: int) -> np.ndarray:
        """All ids of the blocks from ``begin`` to before ``end``."""
        out = np.empty((end - begin, self.block), np.uint32)
        for w in np.unique(self.width[begin:end]).tolist():
            chosen = begin + np.flatnonzero(self.width[begin:end] == w)
            held = _packed_bytes(w, self.block)
            words = np.stack([np.frombuffer(self.data, "<u4", held // 4, self._at + self.starts[b]) for b in chosen.tolist()])
            out[chosen - begin] = _unpacked(words, w, self.block)
        for b in (begin + np.flatnonzero(self.outliers[begin:end])).tolist():
            n, at = int(self.outliers[b]), self._at + int(self.starts[b]) + _packed_bytes(int(self.width[b]), self.block)
            places = np.frombuffer(self.data, "<u2", n, at)
            out[b - begin, places] |= np.frombuffer(self.data, "<u4", n, at + 2 * n) << np.uint32(self.width[b])
        return (out + self.low[begin:end, None]).reshape(-1)

    def ids_at(self, begin: int, count: int) -> np.ndarray:
        """``count`` ids from the ``begin``-th of the segment on; only the blocks that hold them are decoded."""
        end = min(begin + count, self.n_ids)
        if begin < 0 or begin >= end:
            return np.empty(0, np.uint32)
        block = begin // self.block
        return self.blocks(block, -(-end // self.block))[begin - block * self.block : end - block * self.block]

    def documents(self, lot: int = 1 << 20) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """doc_id, place of its first id in the shard, and ids of each document; about ``lot`` ids are decoded at a time."""
        begin, held, held_from = 0, np.empty(0, np.uint32), 0
        for doc_id, size in zip(self.doc_ids, self.sizes.tolist(), strict=True):
            if begin + size > held_from + len(held):
                held, held_from = self.ids_at(begin, max(size, lot)), begin
            yield doc_id, self.first + begin, held[begin - held_from : begin - held_from + size]
            begin += size


def segments(content: bytes) -> Iterator[Segment]:
    """The segments of a file."""
    view, at = memoryview(content), 0
    while at < len(view):
        segment = Segment(view[at:])
        yield segment
        at += segment.size + 1


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    *,
    end_id: int = END_ID,
    segment_ids: int = SEGMENT_IDS,
    shard_bytes: int = SHARD_BYTES,
    block: int = BLOCK,
    percentile: int = PERCENTILE,
) -> None:
    """Encode all documents (doc_id, text) and write them below ``path`` in ascending order of doc_id.

    A null text is empty and leaves ``end_id`` alone. Rows without doc_id come first; rows with one doc_id are put in
    order by a digest of their text and their place in the table, so repeated rows are all written, and a range of rows, not a
    doc_id, is what a task gets. Only doc_id and text are read, other columns may have any name. An empty table leaves files
    without segments. The tokenizer file is read by every worker, so its path must lead to it on all machines.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    held = rows.agg(F.sum(F.octet_length("text")).alias("bytes")).first()["bytes"] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-held // shard_bytes))
    order = ["doc_id", "digest", "place"]
    placed = rows.withColumns({"digest": F.xxhash64("text"), "place": F.monotonically_increasing_id()})
    in_order = placed.repartitionByRange(shards, *order).sortWithinPartitions(*order).select("doc_id", "text")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        code, shard = encoder(tokenizer_path), TaskContext.get().partitionId()
        first, parts, doc_ids, sizes, waiting = 0, [], [], [], 0

        def closed() -> pd.DataFrame:
            return pd.DataFrame({"segment": [encode_segment(np.concatenate(parts), doc_ids, sizes, shard, first, block=block, percentile=percentile)]})

        for frame in frames:
            for doc_id, text in zip(frame["doc_id"].astype("Int64"), frame["text"], strict=True):
                ids = np.append(code.encode(text), np.array(end_id, "<u4"))
                parts.append(ids)
                doc_ids.append(None if doc_id is pd.NA else int(doc_id))
                sizes.append(len(ids))
                waiting += len(ids)
                if waiting >= segment_ids:
                    yield closed()
                    first, parts, doc_ids, sizes, waiting = first + waiting, [], [], [], 0
        if parts:
            yield closed()

    written = in_order.mapInPandas(run, "segment binary").select(F.col("segment").cast("string").alias("value"))
    written.write.option("maxRecordsPerFile", SEGMENTS_PER_FILE).option("lineSep", "\n").option("compression", "none").text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).where("length > 0").select("content")


def _with_starts(found: DataFrame) -> DataFrame:
    """Places in a shard become places in the whole: the shards before are added."""
    held = cut_lineage(found)
    shards = totals_before(held.groupBy("shard").agg(F.sum("n_tokens").alias("ids")), "shard", "ids")
    return held.join(broadcast_if_small(shards), "shard").withColumn("start", F.col("start") + F.col("before")).drop("shard", "before")


def _documents(spark: SparkSession, path: str, schema: str, tail) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for content in frame["content"]:
                for segment in segments(content):
                    rows = [(doc_id, segment.shard, at, len(ids), tail(ids)) for doc_id, at, ids in segment.documents()]
                    found = pd.DataFrame(rows, columns=["doc_id", "shard", "start", "n_tokens", "tail"])
                    found["doc_id"] = found["doc_id"].astype("Int64")
                    yield found

    return _files(spark, path).mapInPandas(run, f"doc_id long, shard long, start long, n_tokens long, tail {schema}")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids (array of long) of every document below ``path``."""
    return _with_starts(_documents(spark, path, "array<long>", lambda ids: ids.astype(np.int64))).withColumnRenamed("tail", "ids")


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """As ``read_token_files``, with ids_crc32 (unsigned, of the ids as little-endian unsigned 32-bit integers) in place of ids."""
    return _with_starts(_documents(spark, path, "long", lambda ids: zlib.crc32(ids.astype("<u4").tobytes()))).withColumnRenamed("tail", "ids_crc32")


def written_digests(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """The documents written to a new folder in the shared one, and what reading the files back gives for each."""
    path = scratch_path(docs.sparkSession, "token-files")
    write_token_files(docs, path, tokenizer_path)
    return read_digests(docs.sparkSession, path)
