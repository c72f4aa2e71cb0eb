"""Near duplicates: b-bit MinHash signatures, joined under a Hamming threshold by multi-index.

A document is the set of its distinct word shingles, hashed to 64 bits. Its signature is 32 minima of the set under as
many hash functions, each cut to 16 bits; the distance of two signatures is the number of positions that
differ. A link needs a Jaccard similarity of at least 85 %, so a position differs with a chance of at most 15 %. For
links from a lower similarity on, signatures have more chunks; the text below has the figures of 8.

By pigeonhole, signatures cut into 8 chunks of 4 positions that differ in at most ``8 * 2 - 1 = 15`` positions agree in some
chunk up to one error. That error is enumerated: a chunk gives four keys, each with one position left out, and two chunks
with at most one error share a key. So every pair within distance 15 shares one of 32 keys. Of linked pairs at the
very threshold, 6 in a million lie beyond that distance, and fewer the more alike they are. With 12 chunks, 48 keys cover
distance 23, beyond which lie 3 in a million of the pairs at 80 %. Every candidate is confirmed on the full sets.

No group is ever gathered or multiplied out:

- Documents with the same set are one class first; copies cost nothing later.
- Within a key, members are first compared with the smallest member only, which is linear in the group. The components
  of the links found are labelled, and what is left to compare are members of *different* components under one key.
- These few documents pass an exact filter before a pair is made. Their shingles are put in one order, rarest first. Of
  two linked sets the first ``n - ceil(85 % of n) + 1`` share one, and where they first meet, what is left of either must
  suffice for the overlap. A copy with many edits begins with shingles of its own, and where it meets its group too
  little is left; so it is paired with hardly anybody, however large the group is. The order comes from counts in
  a table of fixed size; which shingles share a slot changes how well the filter works, not what it keeps.
- Classes, keys and components are met by joins and aggregates that adaptive execution can split.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.components import components
from tallyworks.llm.words import Batch, batches, mix, signed, starts_of
from tallyworks.session import broadcast_if_small, cut_lineage

SHINGLE_WORDS = 3
#: Linked when 100 * intersection >= PERCENT * union.
PERCENT = 85

CHUNKS, CHUNK = 8, 4
POSITIONS = CHUNKS * CHUNK
#: Largest signature distance that the keys cover in full.
MAX_DISTANCE = 2 * CHUNKS - 1
#: Most chunks of a signature.
MOST_CHUNKS = 16
#: Largest share of the pairs at the very threshold that may lie beyond the distance.
LOST = 5e-6

#: Slots of the table of shingle counts that orders shingles; it is sent to every task.
COUNT_SLOTS = 1 << 18

_FACTORS = mix(np.arange(1001, 1001 + MOST_CHUNKS * CHUNK, dtype=np.uint64)) | np.uint64(1)
_OFFSETS = mix(np.arange(2001, 2001 + MOST_CHUNKS * CHUNK, dtype=np.uint64))


def shingle_sets(texts: list[str | None], words: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the shingles of each text.

    A-Z are lower-cased. A text with fewer words than a shingle has its whole sequence as one; without words, none.
    """
    batch = Batch.of(texts, lower=True)
    begin, after, owner = batch.words()
    hashes = batch.hashes(begin, after)
    bounds = starts_of(owner, len(batch))
    count = np.diff(bounds)
    rolled = hashes.copy()
    for k in range(1, words):
        rolled[:-k] = mix(rolled[:-k] * np.uint64(0x9E3779B97F4A7C15)) + hashes[k:]
        rolled[-k:] = mix(rolled[-k:])
    rolled = mix(rolled)
    sets = []
    for a, n in zip(bounds[:-1].tolist(), count.tolist(), strict=True):
        if n >= words:
            sets.append(np.unique(rolled[a : a + n - words + 1]))
        else:
            whole = np.zeros(min(n, 1), np.uint64)
            for h in hashes[a : a + n]:
                whole = mix(whole * np.uint64(31) + h + np.uint64(n))
            sets.append(whole)
    return sets


def lost_share(percent: int, chunks: int) -> float:
    """Share of the pairs with a similarity of ``percent`` whose signatures differ in more positions than the keys cover."""
    positions, apart = chunks * CHUNK, 1 - percent / 100
    return sum(math.comb(positions, k) * apart**k * (1 - apart) ** (positions - k) for k in range(2 * chunks, positions + 1))


def signature(shingles: np.ndarray, chunks: int = CHUNKS) -> np.ndarray:
    """Four minima a chunk, cut to 16 bits, four to a 64-bit chunk."""
    positions = chunks * CHUNK
    low = np.full(positions, 0xFFFFFFFF, np.uint64)
    for part in range(0, len(shingles), 4096):
        hashed = (shingles[part : part + 4096, None] * _FACTORS[:positions] + _OFFSETS[:positions]) >> np.uint64(32)
        low = np.minimum(low, hashed.min(axis=0))
    lanes = (low & np.uint64(0xFFFF)).reshape(chunks, CHUNK)
    return (lanes << np.arange(0, 64, 16, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def _digest_a(shingles: np.ndarray) -> np.uint64:
    return np.bitwise_xor.reduce(mix(shingles), initial=np.uint64(0))


def _set_frame(frame: pd.DataFrame, words: int, rows: Callable[..., pd.DataFrame]) -> Iterator[pd.DataFrame]:
    texts = [t if isinstance(t, str) else None for t in frame["text"]]
    for part in batches(texts):
        yield rows(frame["doc_id"].iloc[part].array, shingle_sets(texts[part], words))


def _chunk_names(chunks: int) -> list[str]:
    return [f"s{i}" for i in range(chunks)]


def signatures(docs: DataFrame, words: int = SHINGLE_WORDS, chunks: int = CHUNKS) -> DataFrame:
    """doc_id, n_shingles, a 128-bit digest of the set (set_a, set_b) and the chunks s0, s1, ...; without shingles all of them 0."""
    chunk_names = _chunk_names(chunks)

    def rows(ids, sets) -> pd.DataFrame:
        empty = np.zeros(chunks, np.uint64)
        lanes = np.array([signature(s, chunks) if len(s) else empty for s in sets], np.uint64).reshape(-1, chunks)
        digests = {"set_a": [_digest_a(s) for s in sets], "set_b": [np.sum(mix(s + np.uint64(77)), dtype=np.uint64) for s in sets]}
        columns = {k: signed(np.array(v, np.uint64)) for k, v in digests.items()}
        return pd.DataFrame({"doc_id": ids, "n_shingles": [len(s) for s in sets], **columns, **dict(zip(chunk_names, signed(lanes.T), strict=True))})

    def run(frames):
        for frame in frames:
            yield from _set_frame(frame, words, rows)

    schema = "doc_id long, n_shingles long, set_a long, set_b long, " + ", ".join(f"{c} long" for c in chunk_names)
    return docs.mapInPandas(run, schema)


def full_sets(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, the first half of the set's digest, and the whole set as an array of longs."""

    def rows(ids, sets) -> pd.DataFrame:
        return pd.DataFrame({"doc_id": ids, "set_a": signed(np.array([_digest_a(s) for s in sets], np.uint64)), "shingles": [signed(s) for s in sets]})

    def run(frames):
        for frame in frames:
            yield from _set_frame(frame, words, rows)

    return docs.mapInPandas(run, "doc_id long, set_a long, shingles array<long>")


#: Masks that leave one of the four positions of a chunk out.
_MASKS = [int(np.array(~(0xFFFF << (16 * lane)) & (2**64 - 1), np.uint64).view(np.int64)) for lane in range(CHUNK)]


def _keys(chunks: int) -> Column:
    """The keys of a signature, four a chunk: each chunk with one of its positions left out."""
    parts = [(c, mask) for c in range(chunks) for mask in _MASKS]
    return F.array(*[F.xxhash64(F.lit(k), F.col(f"s{c}").bitwiseAND(F.lit(mask))) for k, (c, mask) in enumerate(parts)])


def _distance(left: str, right: str, chunks: int) -> Column:
    """Differing positions of two signatures: 16-bit lanes of the xor that are not 0."""
    ones = F.lit(0x0001000100010001)
    total = F.lit(0)
    for c in range(chunks):
        x = F.col(f"{left}.s{c}").bitwiseXOR(F.col(f"{right}.s{c}"))
        for shift in (8, 4, 2, 1):
            x = x.bitwiseOR(F.shiftrightunsigned(x, shift))
        total = total + F.bit_count(x.bitwiseAND(ones))
    return total


def _sizes_fit(a: str, b: str, percent: int) -> Column:
    """Sets of these sizes can be similar enough."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _plausible(pairs: DataFrame, classes: DataFrame, percent: int, chunks: int) -> DataFrame:
    """The pairs (a, b) whose sizes and signatures allow a link."""
    marks = F.struct("n_shingles", *_chunk_names(chunks))
    left, right = (classes.select(F.col("rep").alias(end), marks.alias(f"of_{end}")) for end in "ab")
    met = pairs.join(left, "a").join(right, "b")
    return met.where(_sizes_fit("of_a.n_shingles", "of_b.n_shingles", percent) & (_distance("of_a", "of_b", chunks) <= 2 * chunks - 1)).select("a", "b")


def _sets_of(reps: DataFrame, docs: DataFrame, classes: DataFrame, words: int) -> DataFrame:
    """doc_id and shingles of some classes, made again from the texts of these alone.

    Few documents have a candidate: their ids go to the texts while they fit, and the texts move only beyond that.
    """
    wanted = cut_lineage(classes.join(reps.select("rep").distinct(), "rep", "left_semi").select(F.col("rep").alias("doc_id"), "set_a"))
    texts = docs.join(broadcast_if_small(wanted.select("doc_id")), "doc_id", "left_semi")
    sets = full_sets(texts, words).join(broadcast_if_small(wanted), ["doc_id", "set_a"], "left_semi")
    return cut_lineage(sets.dropDuplicates(["doc_id"]).select("doc_id", "shingles"))


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left, right = (sets.select(F.col("doc_id").alias(end), F.col("shingles").alias(f"of_{end}")) for end in "ab")
    shared = F.size(F.array_intersect("of_a", "of_b"))
    both = F.size("of_a") + F.size("of_b") - shared
    return cut_lineage(pairs.join(right, "b").join(left, "a").where(100 * shared >= percent * both).select("a", "b"))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("rep"))


def _rare_shingles(sets: DataFrame, percent: int) -> DataFrame:
    """rep, place and shingle of the rarest shingles of each set, of which two linked sets share one."""
    slot = F.col("shingle").bitwiseAND(F.lit(COUNT_SLOTS - 1)).cast("int").alias("slot")
    counted = sets.select(F.explode("shingles").alias("shingle")).groupBy(slot).count().toPandas()
    counts = np.zeros(COUNT_SLOTS, np.int64)
    counts[counted["slot"].to_numpy(np.int64)] = counted["count"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            first = []
            for shingles in frame["shingles"]:
                n = len(shingles)
                order = np.lexsort((shingles, counts[shingles & (COUNT_SLOTS - 1)]))
                first.append(shingles[order[: n - (-(-percent * n // 100)) + 1]])
            yield pd.DataFrame({"rep": frame["doc_id"], "shingles": first})

    return sets.mapInPandas(run, "rep long, shingles array<long>").select("rep", F.posexplode("shingles").alias("place", "shingle"))


def _nearly_linked(placed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of classes (rep, component, n_shingles) in different components that may be linked, by the filter above.

    ``left`` is what a set has from a shingle on: no more than that can be shared if the two first meet there.
    """
    rows = cut_lineage(_rare_shingles(sets, percent).join(placed, "rep").withColumn("left", F.col("n_shingles") - F.col("place")))
    enough = lambda left, n, m: (100 + percent) * left >= percent * (n + m)
    met = rows.groupBy("shingle").agg(F.min("n_shingles").alias("least"), F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    rows = rows.join(met.select("shingle", "least"), "shingle").where(enough(F.col("left"), F.col("n_shingles"), F.col("least")))
    a, b = (rows.select("shingle", *[F.col(c).alias(f"{c}_{end}") for c in ("component", "rep", "n_shingles", "left")]) for end in "ab")
    near = (F.col("component_a") < F.col("component_b")) & _sizes_fit("n_shingles_a", "n_shingles_b", percent)
    near &= enough(F.least("left_a", "left_b"), F.col("n_shingles_a"), F.col("n_shingles_b"))
    return a.join(b, "shingle").where(near).select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT, chunks: int = CHUNKS) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) and kept (doc_id = component_id), per document.

    Links follow the sets of whole texts. ``chunks`` must cover ``percent``: 8 do so from 85 on, 12 from 80 on. A document
    without words or text has no shingles and is alone in its component. Rows without doc_id are left out. Repeated rows
    are one document; of different texts under one doc_id, the one whose set has the smallest digest counts. Only doc_id
    and text are read, other columns may have any name. An empty table gives an empty one.
    """
    if not 0 < chunks <= MOST_CHUNKS or lost_share(percent, chunks) > LOST:
        raise ValueError(f"the distance that {chunks} chunks cover is too small for a similarity of {percent} %")
    docs = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    names = _chunk_names(chunks)
    marks = F.min(F.struct("set_a", "set_b", "n_shingles", *names)).alias("of")
    marked = cut_lineage(signatures(docs, words, chunks).groupBy("doc_id").agg(marks).select("doc_id", "of.*"))

    # rows of a class share the signature, so any of them may lend it
    same = marked.where("n_shingles > 0").groupBy("set_a", "set_b")
    classes = cut_lineage(same.agg(F.min("doc_id").alias("rep"), *[F.first(c).alias(c) for c in ("n_shingles", *names)]))

    keyed = classes.select("rep", "n_shingles", F.explode(_keys(chunks)).alias("key"))
    several = keyed.groupBy("key").agg(F.min("rep").alias("first"), F.max("rep").alias("last")).where("first < last").select("key", "first")
    members = cut_lineage(keyed.join(several, "key").where("rep <> first"))

    stars = members.select(F.col("first").alias("a"), F.col("rep").alias("b")).distinct()
    stars = cut_lineage(_plausible(stars, classes, percent, chunks))
    links = _linked(stars, _sets_of(_ends(stars), docs, classes, words), percent)

    # left to compare: members of a key that the links found so far do not connect
    found = components(links)
    placed = members.join(found.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    several = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("key")
    placed = cut_lineage(placed.join(several, "key", "left_semi").select("rep", "component", "n_shingles").distinct())
    if not placed.isEmpty():
        sets = _sets_of(placed, docs, classes, words)
        rest = cut_lineage(_plausible(_nearly_linked(placed, sets, percent), classes, percent, chunks))
        found = components(links.unionByName(_linked(rest, sets, percent)))

    class_of = classes.select("set_a", "set_b", "rep").join(found.withColumnRenamed("node", "rep"), "rep", "left")
    class_of = class_of.select("set_a", "set_b", F.coalesce("component", "rep").alias("component_id"))
    joined = marked.join(class_of, ["set_a", "set_b"], "left")
    component = F.coalesce("component_id", "doc_id")
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), (F.col("doc_id") == component).alias("kept"))
