"""One query per operator over its whole table, and the pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm import (
    ann_codes,
    collocations,
    html_blocks,
    near_dups,
    packing,
    passages,
    pieces,
    prefix_trie,
    quality_lines,
    repetition,
    token_blocks,
    toxicity,
    url_trees,
)

#: The vocabulary files to pack and to encode by; file names of the ``public_tokenizers`` package.
TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: Rows of a batch on its way to Python and back. Spark's default of 10,000 is meant for numbers; of whole texts that many, with
#: their copies on both sides, take a gigabyte.
ROWS_PER_BATCH = 500


def small_batches(spark: SparkSession) -> None:
    """Limit Arrow batches for the session, unless it asks for even smaller ones."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(setting)) <= ROWS_PER_BATCH:
        spark.conf.set(setting, ROWS_PER_BATCH)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_hashed_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_codes.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op2_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality_lines.classify(docs, quality_lines.train(docs, _table(spark, sf_dir, "labels")))


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(_table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with what is left of its text, and the spans that went."""
    return passages.dedupe_passages(_table(spark, sf_dir, "documents"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_trees.judge(_table(spark, sf_dir, "pages"), URL_RULES)


def op6_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = repetition.judge(_table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered_words", "base_failed", "kept")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), _tokenizer(TOKENIZER))


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extract(_table(spark, sf_dir, "pages"))


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and digest of the piece ids of every document, and whether decoding gives its text again."""
    return pieces.encoded_digests(_table(spark, sf_dir, "documents"), _tokenizer(PIECES))


def op11_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, number and digest of the ids of every document, as read back from the files they were written to."""
    return token_blocks.written_digests(_table(spark, sf_dir, "documents"), _tokenizer(TOKENIZER))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(_table(spark, sf_dir, "conversations"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_hashed_neighbours,
        op2_line_quality,
        op3_minhash_dedup,
        op4_substring_dedup,
        op5_url_filter,
        op6_repetition_rules,
        op7_toxicity,
        op8_packing,
        op9_main_text,
        op10_pieces,
        op11_token_blocks,
        op12_prefix_trie,
        op13_collocations,
    )
}
