"""Trie of conversations by their turns, where every conversation is rebuilt from a base's head and its own rest.

No rebuilt conversation is ever written out. A turn has a number, a keyed digest of role and text; a run of turns has a
fingerprint, the pair of its length and the polynomial of those numbers modulo a prime. Fingerprints form a monoid: the one of two
runs laid end to end is ``(m + n, f * B**n + g)``. So with the fingerprints of all beginnings of the original conversations at hand,
a beginning of a rebuilt one follows from three of them: that of the base's head, that of the own turns so far, and that of the own
turns the head replaces.

Beginnings of equal depth and fingerprint are one node. That is not left to chance: every member keeps a reference to the turn its
beginning ends with and the fingerprint before it. All members must have the same one before, and the turns that are referred to
must be the same, character by character; going down from the root, the whole beginnings are then equal. Should two different ones
ever meet, all is done again under another key.

What a node says of its subtree comes from its members alone, without walking the tree. A node belongs to its smallest member;
then a conversation owns the nodes of its path from some depth on, and a sum over the nodes below is a sum over members of what
each owns there.

Turns are put in order by range, so a long conversation lies in many tasks. Each task begins anew, and what a conversation has in
the tasks before is added from a table of those few that cross from one task to the next.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from tallyworks.session import broadcast_if_small, cut_lineage, scratch_path

#: Conversations that share a base, and the remainder that gives the number of turns taken from it.
FAMILY = 20
HEADS = 4
PRIME = (1 << 127) - 1
BASE = 0x2B992DDFA23249D6F1B7E3A95C4D8E11
NOTHING = bytes(16)
#: Characters of role and text by which turns of equal number are put in order before their digest decides.
TIE_CHARS = 64
#: Span of conv_ids whose decimal forms are joined by one task.
ENDS_SPAN = 4096

_WORD = r"[^\x20\x09-\x0D]+"
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def element(role: str, text: str, key: int, bits: int = 127) -> int:
    """The number of a turn: digest of role and text, the role's length in front so that no two turns read alike."""
    first, second = role.encode("utf-8", "surrogatepass"), text.encode("utf-8", "surrogatepass")
    digest = hashlib.blake2b(len(first).to_bytes(8, "little") + first + second, digest_size=16, key=key.to_bytes(8, "little")).digest()
    return (int.from_bytes(digest, "big") & ((1 << bits) - 1)) % PRIME


def _bytes(fingerprint: int) -> bytes:
    return fingerprint.to_bytes(16, "big")


def _int(held: bytes) -> int:
    return int.from_bytes(held, "big")


def then(first: int, second: int, length: int) -> int:
    """Fingerprint of a run followed by one of ``length`` turns."""
    return (first * pow(BASE, length, PRIME) + second) % PRIME


def head_turns(conv_id: Column) -> Column:
    return F.pmod(F.crc32(conv_id.cast("string").cast("binary")), F.lit(HEADS)).cast("int")


def write_turns(conversations: DataFrame, path: str, key: int, bits: int) -> None:
    """Turns in order, with the fingerprint and words of the own conversation so far within the task (``shard``): at the turn
    (``fp``, ``w``) and before it (``before``). ``k`` is the place of the turn there, from 1."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    light = [F.substring("role", 1, TIE_CHARS).alias("r"), F.substring("text", 1, TIE_CHARS).alias("t"), F.xxhash64("role", "text").alias("digest")]
    order = [F.asc("conv"), F.asc_nulls_first("turn"), "r", "t", "digest"]
    in_order = turns.where("conv IS NOT NULL").select("*", *light).repartitionByRange(*order).sortWithinPartitions(*order)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, conv, k, fp, w = TaskContext.get().partitionId(), None, 0, 0, 0
        for frame in frames:
            rows = []
            for c, role, text, words in zip(frame["conv"].tolist(), frame["role"], frame["text"], frame["words"].tolist(), strict=True):
                if c != conv:
                    conv, k, fp, w = c, 0, 0, 0
                before, k, w = fp, k + 1, w + words
                fp = (fp * BASE + element(role, text, key, bits)) % PRIME
                rows.append((c, shard, k, _bytes(fp), _bytes(before), words, w, role, text))
            yield pd.DataFrame(rows, columns=["conv", "shard", "k", "fp", "before", "words", "w", "role", "text"])

    counted = in_order.select("conv", "role", "text", F.regexp_count("text", F.lit(_WORD)).cast("long").alias("words"))
    schema = "conv long, shard int, k long, fp binary, before binary, words long, w long, role string, text string"
    counted.mapInPandas(run, schema).write.parquet(path)


def _carried(turns: DataFrame) -> DataFrame:
    """What conversations that lie in more than one shard have in the shards before: k0, fp0 and w0 per conv and shard.

    Only the first and the last conversation of a shard can do so: no more rows than twice the shards.
    """
    runs = turns.groupBy("conv", "shard").agg(F.max(F.struct("k", "fp", "w")).alias("end"))
    crossing = runs.groupBy("conv").agg(F.count("*").alias("shards")).where("shards > 1").select("conv")

    def fold(frame: pd.DataFrame) -> pd.DataFrame:
        rows, k, fp, w = [], 0, 0, 0
        for row in frame.sort_values("shard").itertuples():
            rows.append((row.conv, row.shard, k, _bytes(fp), w))
            k, fp, w = k + row.k, then(fp, _int(row.fp), row.k), w + row.w
        return pd.DataFrame(rows, columns=["conv", "shard", "k0", "fp0", "w0"])

    ends = runs.join(crossing, "conv").select("conv", "shard", "end.k", "end.fp", "end.w")
    return ends.groupBy("conv").applyInPandas(fold, "conv long, shard int, k0 long, fp0 binary, w0 long")


@F.pandas_udf(BinaryType())
def _after(first: pd.Series, second: pd.Series, length: pd.Series) -> pd.Series:
    """Fingerprint of ``second``, of ``length`` turns, behind ``first``; a null ``first`` is nothing."""
    found = [s if f is None or f == NOTHING else _bytes(then(_int(f), _int(s), int(n))) for f, s, n in zip(first, second, length, strict=True)]
    return pd.Series(found, dtype=object)


@F.pandas_udf(BinaryType())
def _replaced(so_far: pd.Series, head: pd.Series, own_head: pd.Series, rest: pd.Series) -> pd.Series:
    """Fingerprint of a conversation whose ``own_head`` gave way to ``head``, ``rest`` turns after it."""
    found = []
    for f, new, old, n in zip(so_far, head, own_head, rest, strict=True):
        found.append(f if new == old else _bytes((_int(f) + (_int(new) - _int(old)) * pow(BASE, int(n), PRIME)) % PRIME))
    return pd.Series(found, dtype=object)


def _beginnings(turns: DataFrame) -> DataFrame:
    """Every original turn without its text: place, fingerprints and words counted from the start of its conversation."""
    met = turns.drop("role", "text").join(broadcast_if_small(cut_lineage(_carried(turns))), ["conv", "shard"], "left")
    zero = F.lit(0).cast("long")
    return met.select(
        "conv",
        "shard",
        "k",
        "words",
        (F.col("k") + F.coalesce("k0", zero)).alias("at"),
        (F.col("w") + F.coalesce("w0", zero)).alias("w"),
        _after("fp0", "fp", "k").alias("fp"),
        _after("fp0", "before", F.col("k") - 1).alias("before"),
    )


def members(turns: DataFrame) -> DataFrame:
    """One row per rebuilt conversation and depth: conv, depth, fp, before (fp at the depth above), words of the last turn, w (words
    up to it), the turn referred to (ref_conv, ref_shard, ref_k), and of the conversation its depth (length) and words (total)."""
    own = cut_lineage(_beginnings(turns))
    nothing = F.struct(F.lit(0).cast("long").alias("at"), F.lit(NOTHING).alias("fp"), F.lit(0).cast("long").alias("w"))
    head = F.struct("at", "fp", "w", "before", "words", "shard", "k")
    heads = own.groupBy("conv").agg(
        F.max(F.struct("at", "w")).alias("end"), F.array_sort(F.collect_list(F.when(F.col("at") < HEADS, head))).alias("heads")
    )
    base = heads.select(F.col("conv").alias("base"), F.col("heads").alias("base_heads"))
    h = head_turns(F.col("conv")).alias("h")
    convs = heads.select("conv", "end", "heads", h, (F.col("conv") - F.col("conv") % FAMILY).alias("base")).join(base, "base", "left")
    taken = F.least(F.col("h"), F.coalesce(F.size("base_heads"), F.lit(0)))
    convs = convs.withColumn("b", F.greatest(taken, F.lit(0)))

    def at(heads: str, n: str) -> Column:
        found = F.try_element_at(F.col(heads), F.when(F.col(n) > 0, F.col(n)))
        return F.when(F.col(n) > 0, F.struct(found["at"].alias("at"), found["fp"].alias("fp"), found["w"].alias("w"))).otherwise(nothing)

    rest = F.greatest(F.col("end.at") - F.col("h"), F.lit(0))
    whole = F.when(rest > 0, F.col("end.w") - at("heads", "h")["w"]).otherwise(F.lit(0)) + at("base_heads", "b")["w"]
    convs = cut_lineage(
        convs.select(
            "conv", "base", "h", "b", (rest + F.col("b")).alias("length"), whole.alias("total"),
            at("base_heads", "b").alias("new"), at("heads", "h").alias("old"), F.slice("base_heads", F.lit(1), F.col("b")).alias("taken"),
        )
    )
    root = convs.select(
        "conv", F.lit(0).cast("long").alias("depth"), F.lit(NOTHING).alias("fp"), F.lit(NOTHING).alias("before"), F.lit(0).cast("long").alias("words"),
        F.lit(0).cast("long").alias("w"), F.lit(None).cast("long").alias("ref_conv"), F.lit(0).alias("ref_shard"), F.lit(0).cast("long").alias("ref_k"), "length", "total",
    )
    from_base = convs.where("b > 0").select("conv", "base", "length", "total", F.explode("taken").alias("t"))
    from_base = from_base.select(
        "conv", F.col("t.at").alias("depth"), "t.fp", "t.before", "t.words", "t.w", F.col("base").alias("ref_conv"), F.col("t.shard").alias("ref_shard"), F.col("t.k").alias("ref_k"), "length", "total"
    )
    later = own.join(convs.where("length > b").select("conv", "h", "b", "new", "old", "length", "total"), "conv").where("at > h")
    after = F.col("at") - F.col("h")
    later = later.select(
        "conv",
        (F.col("b") + after).alias("depth"),
        _replaced("fp", "new.fp", "old.fp", after).alias("fp"),
        _replaced("before", "new.fp", "old.fp", after - 1).alias("before"),
        "words",
        (F.col("new.w") + F.col("w") - F.col("old.w")).alias("w"),
        F.col("conv").alias("ref_conv"),
        F.col("shard").alias("ref_shard"),
        F.col("k").alias("ref_k"),
        "length",
        "total",
    )
    return root.unionByName(from_base).unionByName(later)


def _top(held: DataFrame) -> DataFrame:
    """Nodes: depth, fp, owner (smallest member), number of members, words, words above the node, the longest member, and what its
    members say of the depth above and of the turn they end with."""
    ref = F.struct("ref_conv", "ref_shard", "ref_k")
    return held.groupBy("depth", "fp").agg(
        F.min("conv").alias("owner"),
        F.count("*").alias("n_convs"),
        F.min(F.col("w") - F.col("words")).alias("above"),
        F.max("length").alias("longest"),
        F.min("before").alias("before"),
        F.max("before").alias("other_before"),
        F.min(ref).alias("ref"),
        F.max(ref).alias("other_ref"),
    )


def all_equal(held: DataFrame, top: DataFrame, turns: DataFrame) -> bool:
    """Whether the members of each node have the node above in common and end with the same turn, read by its references."""
    if top.where("before <> other_before").limit(1).count():
        return False
    unsure = top.where("ref <> other_ref").select("depth", "fp")
    refs = held.join(broadcast_if_small(unsure), ["depth", "fp"], "left_semi").select("depth", "fp", "ref_conv", "ref_shard", "ref_k").distinct()
    texts = turns.select(F.col("conv").alias("ref_conv"), F.col("shard").alias("ref_shard"), F.col("k").alias("ref_k"), "role", "text")
    read = refs.join(texts, ["ref_conv", "ref_shard", "ref_k"])
    seen = read.groupBy("depth", "fp").agg(F.min("role").alias("r"), F.max("role").alias("other_r"), F.min("text").alias("t"), F.max("text").alias("other_t"))
    return not seen.where("r <> other_r OR t <> other_t").limit(1).count()


def _ends(held: DataFrame, span: int = ENDS_SPAN) -> DataFrame:
    """SHA-256 over the conversations that end at a node. Ids of a span are joined first, then each node's parts are read in order,
    so the one task that must see a node's digest grow reads no more than a text of its ids, part by part."""
    ends = held.where("depth = length").select("depth", "fp", "conv", (F.col("conv") - F.pmod(F.col("conv"), F.lit(span))).alias("span"))
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    parts = ends.groupBy("depth", "fp", "span").agg(ids.alias("ids"))

    def digest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, held = None, None
        for frame in frames:
            done = []
            for depth, fp, ids in zip(frame["depth"].tolist(), frame["fp"], frame["ids"], strict=True):
                if (depth, fp) != node:
                    if node is not None:
                        done.append((*node, held.hexdigest()))
                    node, held = (depth, fp), hashlib.sha256()
                else:
                    held.update(b",")
                held.update(ids.encode())
            yield pd.DataFrame(done, columns=["depth", "fp", "ends_sha256"])
        if node is not None:
            yield pd.DataFrame([(*node, held.hexdigest())], columns=["depth", "fp", "ends_sha256"])

    in_order = parts.repartition("depth", "fp").sortWithinPartitions("depth", "fp", "span").select("depth", "fp", "ids")
    return in_order.mapInPandas(digest, "depth long, fp binary, ends_sha256 string")


def trie(conversations: DataFrame, *, bits: int = 127) -> DataFrame:
    """Every node of the trie of rebuilt conversations: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.

    ``conversations`` has conv_id, turn, role and text; other columns may have any name. Turns go by number, null first; those of
    one number by the first characters of role and text, then by a digest, and repeated rows are turns of their own. A null
    role or text is empty. A row without conv_id belongs to no conversation and is left out. An empty table gives no nodes.
    ``bits`` is how much of a turn's digest is used at first; each new attempt takes twice as many.
    """
    for key in range(64):
        path = scratch_path(conversations.sparkSession, "turns")
        write_turns(conversations, path, key, min(127, bits << key))
        turns = conversations.sparkSession.read.parquet(path)
        held = cut_lineage(members(turns))
        top = cut_lineage(_top(held))
        if all_equal(held, top, turns):
            return _nodes(held, top)
    raise RuntimeError("turns could not be told apart")


def _nodes(held: DataFrame, top: DataFrame) -> DataFrame:
    first = top.groupBy(F.col("owner").alias("conv")).agg(F.min(F.struct("depth", "above")).alias("own"))
    leaves = top.where("longest = depth").select(F.col("owner").alias("conv"), F.lit(1).alias("leaf"))
    convs = first.join(leaves, "conv", "left").select("conv", F.col("own.depth").alias("own_from"), F.col("own.above").alias("own_above"), F.coalesce("leaf", F.lit(0)).alias("leaf"))
    each = held.join(convs, "conv", "left").select(
        "depth",
        "fp",
        # a conversation without nodes of its own owns none at all: as if from below its end
        F.coalesce("own_from", F.col("length") + 1).alias("own_from"),
        F.coalesce("own_above", "total").alias("own_above"),
        F.coalesce("leaf", F.lit(0)).alias("leaf"),
        (F.col("w") - F.col("words")).alias("above"),
        "length",
    )
    child = (F.col("own_from") <= F.col("depth") + 1) & (F.col("depth") < F.col("length"))
    shared = F.when(F.col("own_from") > F.col("depth"), F.col("own_above") - F.col("above")).otherwise(F.lit(0))
    below = each.groupBy("depth", "fp").agg(
        F.sum(F.when(child, 1).otherwise(0)).cast("long").alias("n_children"), F.sum("leaf").cast("long").alias("n_leaves"), F.sum(shared).cast("long").alias("saved_tokens")
    )
    parents = top.select((F.col("depth") + 1).alias("depth"), F.col("fp").alias("before"), F.col("owner").alias("parent_conv_id"))
    rows = top.select("depth", "fp", "owner", "n_convs", F.when(F.col("depth") > 0, F.col("before")).alias("before"))
    rows = rows.join(parents, ["depth", "before"], "left").join(below, ["depth", "fp"]).join(_ends(held), ["depth", "fp"], "left")
    return rows.select(
        F.col("owner").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(_NO_ENDS)).alias("ends_sha256")
    )
