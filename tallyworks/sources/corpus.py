"""A folder of text files as a corpus of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.operators.index import term_weights


def read_corpus(spark: SparkSession, folder) -> DataFrame:
    """Lines with the file they come from as ``path``; gzip files are read by their suffix."""
    return spark.read.text(folder).select(F.col("_metadata.file_path").alias("path"), "value")


def corpus_files(spark: SparkSession, folder) -> DataFrame:
    """``path`` and ``bytes`` of every file that is not empty, from the listing alone; no content is read.

    Spark leaves empty files out of every scan, this one included.
    """
    return spark.read.format("binaryFile").load(folder).select("path", F.col("length").alias("bytes"))


def corpus_size(spark: SparkSession, folder) -> int:
    """Number of files, empty ones included, from the listing that every scan holds in the driver; no content is read."""
    return len(spark.read.text(folder).inputFiles())


def file_term_weights(spark: SparkSession, folder) -> DataFrame:
    """Occurrences of a term times ln(files / files with the term), one document per file; files without a word count as well."""
    return term_weights(read_corpus(spark, folder), "path", "value", documents=corpus_size(spark, folder))
