"""Packing: token ids of all documents into windows of fixed size, best fit decreasing.

A document is its token ids and one closing id. One longer than a window is first cut into full windows; what is left of
it is a piece. Full windows are sequences as they are, whatever their number. Pieces, no more than there are documents, are dealt
by hash of their place in the table into groups of about ``group_pieces``, and every group is packed
on its own: longest first, each into the open window with the least room that still holds it. A segment tree over the
remaining capacities finds that window. Groups are what makes the work spread: a group is bounded however large the
table is, and at some ten thousand pieces a group its one last open window does not count.

Token ids never travel: each piece is cut, measured and digested where its text is read, and only its place is dealt out.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 2048
END_ID = 1
#: Pieces packed together by one task.
GROUP_PIECES = 16_384
#: Bits of a piece's number that count within a task.
TASK_BITS = 33

_encoders: dict[str, Encoder] = {}


def _merge_ranks(path: str) -> dict[bytes, int]:
    """Byte strings of a byte-level vocabulary and their ids, which follow the order of the merges.

    Such a file writes a byte as the character of its number where that is printable, else as one from 256 on.
    """
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte_of = {chr(b): b for b in plain}
    byte_of.update((chr(256 + i), b) for i, b in enumerate(b for b in range(256) if b not in byte_of.values()))
    return {bytes(map(byte_of.__getitem__, piece)): rank for piece, rank in vocabulary.items() if all(c in byte_of for c in piece)}


class Encoder:
    """Token ids by a byte-level tokenizer file, which is applied as ``encode(text, add_special_tokens=False)`` would.

    The merges run in ``tiktoken``, three times as fast over the same vocabulary; only a text that holds one of the
    tokenizer's special strings takes the slower library, which knows them.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        self.path, self.with_special = path, None
        with open(path, encoding="utf-8") as file:
            self.special = [t["content"] for t in json.load(file)["added_tokens"]]
        ranks = {k: v for k, v in _merge_ranks(path).items() if k.decode("utf-8", "replace") not in self.special}
        self.ordinary = tiktoken.Encoding("merges", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, "<u4")
        if any(s in text for s in self.special):
            from tokenizers import Tokenizer

            self.with_special = self.with_special or Tokenizer.from_file(self.path)
            return np.array(self.with_special.encode(text, add_special_tokens=False).ids, "<u4")
        return np.array(self.ordinary(text), "<u4")


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def best_fit_decreasing(lengths: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Window number and offset of each piece, given lengths from 1 to ``window``.

    ``tree`` is a segment tree over capacities 0..window: a leaf tells how many open windows have that room, an inner
    node the sum below it. The smallest capacity of at least the piece's length is found by climbing from the leaf to
    the first node with an occupied right neighbour, then descending to its leftmost leaf. Equal lengths are packed in
    the order given, and of equal windows the last one opened is used.
    """
    leaves = 1 << int(window).bit_length()
    tree = [0] * (2 * leaves)
    open_at: list[list[int]] = [[] for _ in range(window + 1)]
    used: list[int] = []
    number, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)

    def add(capacity: int, change: int) -> None:
        node = leaves + capacity
        while node:
            tree[node] += change
            node >>= 1

    for piece in np.argsort(-np.asarray(lengths), kind="stable").tolist():
        size = int(lengths[piece])
        node = leaves + size
        if not tree[node]:
            while node > 1 and (node & 1 or not tree[node + 1]):
                node >>= 1
            if node > 1:
                node += 1
                while node < leaves:
                    node *= 2
                    node += not tree[node]
        if node > 1:
            room = node - leaves
            at = open_at[room].pop()
            add(room, -1)
        else:
            room, at = window, len(used)
            used.append(0)
        number[piece], offset[piece] = at, used[at]
        used[at] += size
        if room > size:
            open_at[room - size].append(at)
            add(room - size, 1)
    return number, offset


def cut_pieces(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``window`` ids: doc_id, start, length, ids_crc32, doc_tokens (and ids, if asked for), and ``piece``,
    a number that no other piece has: the task's, shifted by ``TASK_BITS``, and a count within it.

    The tokenizer file is read by every worker, so its path must lead to it on all machines.
    """
    columns = ["known_id", "start", "length", "ids_crc32", "doc_tokens", "piece", "has_id"] + ["ids"] * with_ids
    schema = "known_id long, start long, length long, ids_crc32 long, doc_tokens long, piece long, has_id boolean" + ", ids array<int>" * with_ids

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        code, number = encoder(tokenizer_path), TaskContext.get().partitionId() << TASK_BITS
        for frame in frames:
            rows = []
            for known_id, has_id, text in zip(frame["known_id"], frame["has_id"], frame["text"], strict=True):
                ids = np.append(code.encode(text), np.array(end_id, "<u4"))
                for start in range(0, len(ids), window):
                    piece = ids[start : start + window]
                    row = (known_id, start, len(piece), zlib.crc32(piece.tobytes()), len(ids), number, has_id)
                    rows.append((*row, piece.astype(np.int32)) if with_ids else row)
                    number += 1
            yield pd.DataFrame(rows, columns=columns)

    # a null among whole numbers would make them floating-point in Python
    doc_id = F.col("doc_id").cast("long")
    texts = docs.select(F.coalesce(doc_id, F.lit(0)).alias("known_id"), doc_id.isNotNull().alias("has_id"), F.col("text").cast("string").alias("text"))
    pieces = texts.mapInPandas(cut, schema)
    return pieces.select(F.when(F.col("has_id"), F.col("known_id")).alias("doc_id"), *columns[1:5], "piece", *columns[7:])


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    window: int = WINDOW,
    end_id: int = END_ID,
    group_pieces: int = GROUP_PIECES,
    with_ids: bool = False,
) -> DataFrame:
    """All documents (doc_id, text) as pieces placed in sequences of at most ``window`` ids.

    Returns the columns of ``cut_pieces`` but ``piece``, with sequence_id and offset. Within a sequence the pieces lie gapless
    from 0. A null text is empty: it gives one piece with the closing id alone. Rows without doc_id are packed like any other;
    repeated rows are packed as often as they occur. Only doc_id and text are read, other columns may have any name.
    An empty table gives no pieces. Which group a piece joins depends on its place in the table alone, so copies spread, and in
    a group order is by length, document and start, so a task that is run again makes the same sequences.
    """
    pieces = cut_pieces(docs, tokenizer_path, window, end_id, with_ids)
    rows = docs.count()
    groups = max(1, -(-rows // group_pieces))
    columns = [c for c in pieces.columns if c not in ("doc_id", "piece")]
    id_columns = [F.coalesce("doc_id", F.lit(0)).alias("known_id"), F.col("doc_id").isNotNull().alias("has_id")]
    # full windows pass in lots, by their number in the task
    full = F.col("length") == window
    group = F.when(full, groups + F.expr(f"piece div {group_pieces}")).otherwise(F.pmod(F.xxhash64("piece"), F.lit(groups)))
    dealt = pieces.select(*id_columns, *columns, "piece", group.alias("pack_group"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dealt.schema if f.name not in ("piece", "pack_group"))

    def place(frame: pd.DataFrame) -> pd.DataFrame:
        group, piece = frame.pop("pack_group"), frame["piece"]
        if group.iloc[0] >= groups:
            return frame.assign(sequence_id=2 * piece + 1, offset=0).drop(columns="piece")
        frame = frame.sort_values(["length", "has_id", "known_id", "start", "ids_crc32", "piece"], ascending=[False, *[True] * 5], kind="stable")
        number, offset = best_fit_decreasing(frame["length"].to_numpy(), window)
        return frame.drop(columns="piece").assign(sequence_id=2 * (group.iloc[0] + groups * number), offset=offset)

    placed = dealt.groupBy("pack_group").applyInPandas(place, f"{kinds}, sequence_id long, offset long")
    return placed.select(F.when(F.col("has_id"), F.col("known_id")).alias("doc_id"), *columns, "sequence_id", "offset")


def padding(lengths: np.ndarray, window: int = WINDOW) -> int:
    """Ids that fill sequences of these lengths up to ``window``; a length that is a power of two is left as it is."""
    lengths = np.asarray(lengths, np.int64)
    return int(np.where(lengths & (lengths - 1), window - lengths, 0).sum())
