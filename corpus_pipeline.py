"""Documents to packed training sequences, in five stages.

Each stage works on all that the one before it kept, and is written as Parquet before the next one reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm import near_dups, packing, passages, quality_lines, toxicity
from tallyworks.llm.queries import TOKENIZER, small_batches
from tallyworks.session import broadcast_if_small, cut_lineage, scratch_path


#: A near copy shares this share of its shingles of so many words; twelve chunks of a signature cover it.
NEAR_WORDS, NEAR_PERCENT, NEAR_CHUNKS = 5, 80, 12


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def _fresh(docs: DataFrame, name: str) -> str:
    """The name, or one like it that no column of the documents has."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def _as_before(found: DataFrame, docs: DataFrame) -> DataFrame:
    return found.select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below the threshold. A null or empty text is scored like any other."""
    small_batches(spark)
    model, score = toxicity.train(docs, _labels(spark, sf_dir)), _fresh(docs, "toxicity_score")
    return _as_before(toxicity.with_score(docs, model, name=score).where(F.col(score) < toxicity.THRESHOLD), docs)


def drop_bad(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score from the threshold on; all of them where the labels give no model."""
    small_batches(spark)
    model, score = quality_lines.train(docs, _labels(spark, sf_dir)), _fresh(docs, "quality_score")
    if model is None:
        return docs
    return _as_before(quality_lines.with_score(docs, model, name=score).where(F.col(score) >= quality_lines.THRESHOLD), docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id.

    Of rows with one id and one text a single one stays; different texts of one id stay or go together. Documents without id stay.
    """
    small_batches(spark)
    marked = near_dups.near_duplicates(docs, words=NEAR_WORDS, percent=NEAR_PERCENT, chunks=NEAR_CHUNKS)
    gone = marked.where(~F.col("kept")).select("doc_id")
    left = _as_before(docs.join(broadcast_if_small(gone), "doc_id", "left_anti"), docs)
    twice = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("doc_id is not null and n > 1").select("doc_id")
    twice = broadcast_if_small(cut_lineage(twice))
    repeated = left.join(twice, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return _as_before(left.join(twice, "doc_id", "left_anti"), docs).unionByName(_as_before(repeated, docs))


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that an earlier document holds; a document of nothing else goes. Documents without id stay whole."""
    small_batches(spark)
    name = _fresh(docs, "deduped")
    cut = passages.with_passages_removed(docs, name=name)
    removed, text = F.col(f"{name}.removed_words"), F.col(f"{name}.text")
    left = cut.where((removed == 0) | text.rlike(r"[^\x20\x09-\x0D]"))
    changed = {"text": text}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(removed > 0, F.length(text)).otherwise(F.col("n_chars")).cast("long")
    return _as_before(left.withColumns(changed), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences of 2048 ids. Documents without id are packed as well."""
    small_batches(spark)
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality classifier", drop_bad),
    ("near-dedup", drop_near_copies),
    ("substring dedup", cut_passages),
    ("packing", pack),
]

#: The classifiers, the chunks and the tokenizer are beyond SQL. Tests hold near-dedup and packing against brute force, and the
#: other stages against planted cases and held-out labels.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over all documents of ``sf_dir``; what a stage keeps lies in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
