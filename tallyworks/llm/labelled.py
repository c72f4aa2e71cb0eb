"""Which labelled documents a classifier may learn from, and which are held out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 4
HELD_OUT = 2


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves the remainder that is kept from learning; false for a null id."""
    remainder = F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(FOLDS))
    return F.coalesce(remainder == HELD_OUT, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, target: str, rows: int) -> DataFrame:
    """doc_id, text and label (0 or 1) of at most ``rows`` labelled documents that are not held out, taken by hash of the id.

    ``rows`` bounds what is broadcast and learned from; labels that are null or contradict each other are left out.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(target).isin(0, 1) & ~held_out())
    each = usable.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(target).alias("label"), F.max(target).alias("other"))
    chosen = each.where("label = other").select("doc_id", "label").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id")
