"""Approximate nearest neighbours: multi-index hashing over learned binary codes.

Codes: vectors are centred and turned by rotations that were learned on a sample (from principal axes, alternating between
rounding to signs and the best rotation towards them, each of two rotations from another start); the signs are the bits.
Index: the rows are dealt into blocks, and in each block the code is cut into substrings of 8 bits, each with a table from its
256 values to the rows that have it. Search: codes within ``radius`` of a query differ by at most radius // substrings bits in
one of them, so probing all values that near in every table finds each of them. They are checked for the radius, and the
floats decide.

The radius is that which ``COVER`` of the nearest neighbours in the sample keep. A sample is sparser than the table, so its
neighbours are farther and the radius errs on the wide side. Queries and rows meet in cells of a grid, a block of rows with a
batch of queries, so a task holds two bounded groups whatever the table's size; copies of one vector spread over all blocks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rows that the rotations and the radius are learned from, at most.
SAMPLE_ROWS = 4000
BITS, SUBSTRING = 128, 8
#: Part of the sample's nearest neighbours that the radius covers.
COVER = 0.97
ROUNDS = 30
#: Rows of a block and queries of a batch, about.
BLOCK_ROWS, BATCH_QUERIES = 32_768, 2048

_BITS_SET = np.array([bin(v).count("1") for v in range(256)], np.uint8)
#: For each radius, the differences a substring may have.
_DIFFERENCES = [np.flatnonzero(_BITS_SET <= r) for r in range(SUBSTRING + 1)]


@dataclass
class Codes:
    """Learned centre and rotations, and the radius of a search."""

    centre: np.ndarray
    turn: np.ndarray  # dimensions x BITS
    radius: int

    def of(self, vectors: np.ndarray) -> np.ndarray:
        """Packed codes, one byte for each substring."""
        return np.packbits((vectors - self.centre) @ self.turn > 0, axis=1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def learn(vectors: np.ndarray, neighbours: int, seed: int = 7) -> Codes:
    """Rotations and radius from a sample of vectors, none of them zero."""
    unit = _unit(vectors)
    centre = unit.mean(axis=0)
    shifted, width = unit - centre, unit.shape[1]
    axes = np.linalg.eigh(shifted.T @ shifted)[1][:, ::-1]
    random, turns = np.random.default_rng(seed), []
    while sum(t.shape[1] for t in turns) < BITS:
        turn = np.linalg.qr(random.standard_normal((width, width)))[0]
        for _ in range(ROUNDS):
            signs = np.where(shifted @ axes @ turn > 0, 1.0, -1.0)
            left, _, right = np.linalg.svd((shifted @ axes).T @ signs)
            turn = left @ right
        turns.append(axes @ turn)
    codes = Codes(centre, np.hstack(turns)[:, :BITS], BITS)
    packed = codes.of(unit)
    found = []
    for begin in range(0, len(unit), 500):
        near = unit[begin : begin + 500] @ unit.T
        near[np.arange(len(near)), begin + np.arange(len(near))] = -2
        best = np.argsort(-near, axis=1)[:, : min(neighbours, len(unit) - 1)]
        apart = _BITS_SET[packed[begin : begin + 500, None, :] ^ packed[best]].sum(axis=2, dtype=np.int64)
        found.append(apart.ravel())
    apart = np.concatenate(found) if found else np.empty(0)
    codes.radius = int(np.ceil(np.quantile(apart, COVER))) if len(apart) else BITS
    return codes


class Index:
    """The substring tables of a block of codes."""

    def __init__(self, packed: np.ndarray):
        self.packed = packed
        self.rows = np.argsort(packed, axis=0, kind="stable").T
        self.begin = np.stack([np.searchsorted(np.sort(column), np.arange(257)) for column in packed.T])

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """All rows whose code differs from ``code`` in at most ``radius`` bits."""
        tables = len(code)
        near = _DIFFERENCES[min(radius // tables, SUBSTRING)]
        met = np.zeros(len(self.packed), bool)
        for table in range(tables):
            values = near ^ code[table]
            begin, end = self.begin[table][values], self.begin[table][values + 1]
            size = end - begin
            slots = np.repeat(begin - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
            met[self.rows[table][slots]] = True
        rows = np.flatnonzero(met)
        return rows[_BITS_SET[self.packed[rows] ^ code].sum(axis=1, dtype=np.int64) <= radius]


def _usable(column: str) -> Column:
    """A vector without null, NaN or infinite components, and not zero."""
    v = F.col(column)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & fine & F.exists(v, lambda x: x != 0)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), np.float64)


def search(rows: DataFrame, is_query: Column, neighbours: int = 5, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """query_id, rank, vec_id and score (cosine) of the nearest rows found for each query row, nearest first.

    ``rows`` has vec_id and embedding; ``is_query`` tells which of them are queries. Candidates are all rows but the
    query's own id; ties go to the smaller vec_id. A query with fewer than ``neighbours`` within the radius looks at all
    rows of its cells, so it goes short only where the table does. Rows without vec_id, and vectors that are null, empty, zero
    or hold null or non-finite components, take no part; so do vectors of another length than most of the
    sample's. Repeated rows count once. Other columns may have any name. An empty table gives an empty one.
    """
    spark = rows.sparkSession
    schema = "query_id long, vec_id long, score double"
    usable = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), is_query.alias("is_query"))
    usable = usable.where(F.col("vec_id").isNotNull() & _usable("embedding"))
    sample = usable.select("vec_id", "embedding").orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).toPandas()
    if sample.empty:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width = int(sample["embedding"].map(len).mode()[0])
    sample = sample[sample["embedding"].map(len) == width].drop_duplicates("vec_id")
    codes = learn(_matrix(sample["embedding"]), neighbours)
    usable = usable.where(F.size("embedding") == width)

    total = usable.agg(F.count("*").alias("n"), F.count_if("is_query").alias("queries")).first()
    blocks, groups = max(1, -(-total["n"] // BLOCK_ROWS)), max(1, -(-total["queries"] // BATCH_QUERIES))
    deal = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    base = usable.select("vec_id", "embedding", deal(blocks).cast("int").alias("block"), every(groups).alias("part"))
    asked = usable.where("is_query").select("vec_id", "embedding", deal(groups).cast("int").alias("part"), every(blocks).alias("block"))

    def meet(queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        queries, block = queries.drop_duplicates("vec_id"), block.drop_duplicates("vec_id").sort_values("vec_id")
        if queries.empty or block.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        vectors, ids = _matrix(block["embedding"]), block["vec_id"].to_numpy()
        norms = np.linalg.norm(vectors, axis=1)
        index = Index(codes.of(vectors / norms[:, None]))
        wanted = _matrix(queries["embedding"])
        coded = codes.of(_unit(wanted))
        found = []
        for query, vector, code in zip(queries["vec_id"].tolist(), wanted, coded, strict=True):
            near = index.within(code, codes.radius)
            if len(near) <= neighbours:
                near = np.arange(len(ids))
            near = near[ids[near] != query]
            scores = (vectors[near] @ vector) / (norms[near] * np.linalg.norm(vector))
            if len(near) > neighbours:  # all ties with the last stay in
                least = np.partition(scores, len(near) - neighbours)[len(near) - neighbours]
                near, scores = near[scores >= least - 1e-12], scores[scores >= least - 1e-12]
            best = np.lexsort((ids[near], -scores))[: neighbours + 1]
            found.append(pd.DataFrame({"query_id": query, "vec_id": ids[near][best], "score": scores[best]}))
        return pd.concat(found)

    cells = asked.groupBy("block", "part").cogroup(base.groupBy("block", "part")).applyInPandas(meet, schema)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = cells.where("vec_id is not null").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= neighbours)
    return ranked.select("query_id", "rank", "vec_id", "score")
