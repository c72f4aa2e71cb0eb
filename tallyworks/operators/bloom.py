"""Blocked Bloom filters: all bits of a value lie in one block, so a value meets its filter in one step.

A block has eight words of 64 bits; a value sets one bit in each. Its block and its bits are a function of the value and
the number of blocks alone. The filter is a table of blocks, made by one aggregate and as large as it has to be: rows meet
their block in one join, whether Spark sends the blocks to all executors or shuffles both sides. A filter of up to
``MAX_BITS`` can also be held by every executor, to probe arrays of values. The same values pass either way.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.functions.text import raw_tokens
from tallyworks.operators.nesting import nest
from tallyworks.session import fits_broadcast

#: Largest filter, in bits, that is sent to every executor (16 MiB). Larger ones stay distributed.
MAX_BITS = 1 << 27
#: Largest member set, in bytes, that is looked up itself instead of through a filter.
MEMBER_BYTES = 16 * 1024 * 1024

WORDS = 8
WORD_BITS = 64
BLOCK_BITS = WORDS * WORD_BITS


def filter_size(members: int, false_positives: float) -> tuple[int, int]:
    """Bits and hash functions of a filter without blocks for a number of members and a rate of false positives."""
    bits = max(1, int(-members * math.log(false_positives) / math.log(2) ** 2))
    return bits, max(1, round(bits / max(members, 1) * math.log(2)))


def _rate(load: float) -> float:
    """False positives when blocks hold ``load`` values on average.

    How many a block holds follows a Poisson distribution; a block with n has a bit set in a word with 1 - (1 - 1/64)^n.
    """
    most = int(load + 12 * math.sqrt(load) + 12)
    chance, rate = math.exp(-load), 0.0
    for n in range(1, most):
        chance *= load / n
        rate += chance * (1 - (1 - 1 / WORD_BITS) ** n) ** WORDS
    return rate


def block_count(members: int, false_positives: float) -> int:
    """Blocks that keep the rate of false positives for a number of members."""
    if not 0 < false_positives < 1:
        raise ValueError("the rate of false positives lies between 0 and 1")
    low, high = 1e-6, 500.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if _rate(middle) <= false_positives else (low, middle)
    return max(1, math.ceil(members / low))


def _place(value: Column, blocks: int) -> tuple[Column, Column]:
    """Block of a value, and a hash that holds six bits for each word of the block."""
    text = value.cast("string")
    return F.pmod(F.xxhash64(text), F.lit(blocks).cast("bigint")), F.xxhash64(text, F.lit("bits"))


def _bit(hashed: Column, word: int) -> Column:
    """The place of the bit in a word of the block."""
    return F.shiftright(hashed, 6 * word).bitwiseAND(F.lit(WORD_BITS - 1)).cast("int")


@dataclass(frozen=True)
class BlockedBloom:
    """A filter as a table: ``block`` and its words ``w0`` to ``w7``; blocks without a bit are left out."""

    table: DataFrame
    blocks: int

    @property
    def bits(self) -> int:
        return self.blocks * BLOCK_BITS

    @property
    def fits(self) -> bool:
        """Whether every executor may hold it."""
        return self.bits <= MAX_BITS

    def keep(self, df: DataFrame, value: str | Column) -> DataFrame:
        """Rows whose value may be a member; none with a null value is kept.

        One equi-join with the blocks. A small filter is sent to the rows; otherwise both sides are shuffled by block, and
        rows of one frequent value, which all want the same block, are split by adaptive execution.
        """
        column = F.col(value) if isinstance(value, str) else value
        block, hashed = _place(column, self.blocks)
        placed = df.where(column.isNotNull()).withColumns({"_bloom_block": block, "_bloom_bits": hashed})
        words = self.table.select(F.col("block").alias("_bloom_block"), *[F.col(f"w{i}").alias(f"_bloom_w{i}") for i in range(WORDS)])
        met = placed.join(F.broadcast(words) if self.fits else words, "_bloom_block")
        one = F.lit(1).cast("bigint")
        hits = [F.call_function("shiftright", F.col(f"_bloom_w{i}"), _bit(F.col("_bloom_bits"), i)).bitwiseAND(one) == one for i in range(WORDS)]
        return met.where(reduce(Column.__and__, hits)).select(*df.columns)

    def held(self) -> BloomFilter:
        """The filter in every executor. At most ``MAX_BITS`` come to the driver on the way."""
        if not self.fits:
            raise ValueError(f"{self.bits} bits are too many to broadcast")
        rows = self.table.toArrow()
        words = np.zeros((self.blocks, WORDS), dtype=np.int64)
        for i in range(WORDS):
            words[rows["block"].to_numpy(), i] = rows[f"w{i}"].to_numpy()
        return BloomFilter(self.table.sparkSession.sparkContext.broadcast(words), self.blocks)

    def write(self, path: str) -> None:
        """Save the filter; the number of blocks stands in every row, and in one without block for a filter without members."""
        none = self.table.sparkSession.range(1).select(F.lit(None).cast("bigint").alias("block"))
        rows = self.table.unionByName(none, allowMissingColumns=True).withColumn("blocks", F.lit(self.blocks).cast("bigint"))
        rows.write.mode("overwrite").parquet(path)


def read_bloom(spark: SparkSession, path: str) -> BlockedBloom:
    """A filter that was written."""
    rows = spark.read.parquet(path)
    return BlockedBloom(rows.where("block is not null").drop("blocks"), rows.select("blocks").first()[0])


def blocked_bloom(df: DataFrame, column: str, members: int, false_positives: float) -> BlockedBloom:
    """Filter of the values of a column, of which there are about ``members`` different ones.

    One aggregate: each task merges its values into blocks before they are shuffled.
    """
    blocks = block_count(members, false_positives)
    block, hashed = _place(F.col(column), blocks)
    one = F.lit(1).cast("bigint")
    values = df.where(F.col(column).isNotNull()).select(block.alias("block"), hashed.alias("_bits"))
    masks = [F.bit_or(F.call_function("shiftleft", one, _bit(F.col("_bits"), i))).alias(f"w{i}") for i in range(WORDS)]
    return BlockedBloom(values.groupBy("block").agg(*masks), blocks)


@dataclass(frozen=True)
class BloomFilter:
    """The words of all blocks, held once per executor."""

    words: Broadcast
    blocks: int

    def any_member(self, values: Column) -> Column:
        """Whether any element of an array column may be a member; false for an empty array."""
        words, blocks = self.words, self.blocks

        @F.arrow_udf("boolean")
        def probe(pairs: pa.Array) -> pa.Array:
            table = words.value
            offsets = pairs.offsets.to_numpy() // 2
            numbers = pairs.values.to_numpy(zero_copy_only=False).reshape(-1, 2)
            hit = np.ones(len(numbers), dtype=bool)
            for i in range(WORDS):
                hit &= (table[numbers[:, 0], i] >> ((numbers[:, 1] >> (6 * i)) & (WORD_BITS - 1))) & 1 == 1
            upto = np.concatenate(([0], np.cumsum(hit)))
            return pa.array(upto[offsets[1:]] > upto[offsets[:-1]])

        pairs = F.flatten(F.transform(values, lambda v: F.array(*_place(v, blocks))))
        # taken for random, lest the filter is moved to a scan of few tasks, ahead of where its rows are dealt out
        return probe.asNondeterministic()(F.coalesce(pairs, F.array().cast("array<bigint>")))

    def may_contain(self, value: str | Column) -> Column:
        column = F.col(value) if isinstance(value, str) else value
        return self.any_member(F.when(column.isNotNull(), F.array(column)))


def build_bloom(df: DataFrame, column: str, members: int, false_positives: float) -> BloomFilter:
    """Filter of the values of a column, held by every executor; ``ValueError`` if it has more than ``MAX_BITS``."""
    return blocked_bloom(df, column, members, false_positives).held()


def _distinct_members(members: DataFrame, member: str) -> DataFrame:
    return members.select(F.col(member).cast("string").alias("_member")).dropna().distinct()


def _bloom_of(known: DataFrame, false_positives: float) -> BlockedBloom:
    """Filter of different members, sized by their number."""
    return blocked_bloom(known, "_member", known.count(), false_positives)


def _likely(df: DataFrame, key: str, known: DataFrame, false_positives: float) -> DataFrame:
    """Rows that pass the filter of different members before they are shuffled; all rows if it is too large to be sent."""
    bloom = _bloom_of(known, false_positives)
    return bloom.keep(df, key) if bloom.fits else df


def bloom_filter_keys(
    df: DataFrame, key: str, members: DataFrame, member: str, false_positives: float = 0.01, *, exact: bool = True
) -> DataFrame:
    """Rows whose key, as text, is among the members, at every size of the member set.

    The filter keeps most other rows from the shuffle while it is small enough to broadcast; a semi join
    decides. So neither the number of members nor ``false_positives`` changes the result. Without ``exact`` the filter
    decides: no member is lost, and of other keys about the share ``false_positives`` passes, at every size as well.
    """
    known = _distinct_members(members, member)
    if not exact:
        return _bloom_of(known, false_positives).keep(df, key)
    return _likely(df, key, known, false_positives).join(known, F.col(key).cast("string") == F.col("_member"), "left_semi")


def _any_of(members: DataFrame, member: str, tokens: Column) -> Column:
    """Whether any token is one of a bounded set of members, held once per executor."""
    held = members.sparkSession.sparkContext.broadcast(members.select(member).toArrow()[member].combine_chunks())

    @F.arrow_udf("boolean")
    def probe(lists: pa.Array) -> pa.Array:
        offsets = lists.offsets.to_numpy()
        hit = pc.is_in(lists.values, value_set=held.value).to_numpy(zero_copy_only=False)
        upto = np.concatenate(([0], np.cumsum(hit)))
        return pa.array(upto[offsets[1:]] > upto[offsets[:-1]])

    return probe.asNondeterministic()(tokens)


def bloom_filter_tokens(
    df: DataFrame,
    text: str,
    members: DataFrame,
    member: str,
    false_positives: float = 0.01,
    *,
    exact_on: Sequence[str] | None = None,
    max_bytes: int = MEMBER_BYTES,
) -> DataFrame:
    """Rows with a text in which any cleaned token may be among the members, each row once.

    With ``exact_on``, the columns that identify a row, none is kept by a false positive: a member
    set measured below ``max_bytes`` is looked up itself, without a shuffle; beyond it, the tokens of
    rows that pass the filter are checked by a semi join. Rows are known by a digest of their text there, so
    null and repeated ids make no difference.
    """
    known = _distinct_members(members, member)
    rows = df.dropna(subset=[text])
    if exact_on is not None and fits_broadcast(known, max_bytes):
        return rows.filter(_any_of(known, "_member", raw_tokens(text)))
    bloom = _bloom_of(known, false_positives)
    if bloom.fits:
        rows = rows.filter(bloom.held().any_member(raw_tokens(text)))
        if exact_on is None:
            return rows
    digest = F.sha2(F.col(text).cast("string"), 256)
    tokens = rows.select(digest.alias("_digest"), F.explode(raw_tokens(text)).alias("_token"))
    if exact_on is None:
        found = bloom.keep(tokens, "_token")
    else:
        found = tokens.join(known, F.col("_token") == F.col("_member"), "left_semi")
    return rows.join(found.select("_digest").distinct(), digest == F.col("_digest"), "left_semi")


def bloom_nest(
    parents: DataFrame,
    parent_key: str,
    measure: str,
    threshold,
    children: DataFrame,
    child_key: str,
    child_columns: Sequence[str],
    false_positives: float = 0.01,
    *,
    both_sides: bool = False,
    **options,
) -> DataFrame:
    """Parents at or above a threshold with their children, without the childless.

    The filter of the chosen parents is applied to the children before they are shuffled; with ``both_sides`` a filter
    of the keys of those children is applied to the chosen parents in turn, so that few parents without children are
    shuffled. The join itself is exact.
    """
    chosen = parents.filter(F.col(measure) >= threshold)
    related = _likely(children, child_key, _distinct_members(chosen, parent_key), false_positives)
    if both_sides:
        chosen = _likely(chosen, parent_key, _distinct_members(related, child_key), false_positives)
    return nest(chosen, related, parent_key, child_key, child_columns, keep_childless=False, **options)
