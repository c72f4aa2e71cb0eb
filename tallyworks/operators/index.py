"""Inverted index and term weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.text import explode_words, first_link, letter_tokens, unescape_html
from tallyworks.operators.nesting import PART_ITEMS, gather
from tallyworks.session import cut_lineage


def inverted_index(df: DataFrame, body: str, key: str, prefix: str, *, part_items: int = PART_ITEMS) -> DataFrame:
    """Ids of the rows that link to an address, per address: sorted, blank-separated.

    An address linked from very many rows is continued in further parts.
    """
    link = first_link(unescape_html(F.lower(F.col(body))), prefix)
    # written once: the narrow table of links is looked at twice, the texts only here
    linked = cut_lineage(df.select(link.alias("url"), F.col(key).alias("_id")).dropna())
    ids = gather(linked, ["url"], F.col("_id"), out="_ids", part_items=part_items)
    return ids.select("url", "part", F.array_join(F.col("_ids").cast("array<string>"), " ").alias("ids"))


def _document_counts(df: DataFrame, document: str, text: str | Column, whole_rows: bool) -> DataFrame:
    """Occurrences per term and the number of documents with it."""
    if not whole_rows:
        words = explode_words(df, text, keep=[document])
        per_document = words.groupBy("word", document).agg(F.count("*").alias("_n"))
        return per_document.groupBy("word").agg(F.sum("_n").alias("tf"), F.count("*").alias("df"))
    # every word once per occurrence, and once more with a blank behind it per row
    words = df.select(letter_tokens(text).alias("_words"))
    once = F.transform(F.array_distinct("_words"), lambda w: F.concat(w, F.lit(" ")))
    marked = words.select(F.explode(F.concat("_words", once)).alias("_word"))
    is_mark = F.col("_word").endswith(" ")
    return marked.groupBy(F.rtrim("_word").alias("word")).agg(
        F.count_if(~is_mark).alias("tf"), F.count_if(is_mark).alias("df")
    )


def term_weights(
    df: DataFrame,
    document: str,
    text: str | Column,
    *,
    documents: int | Column | None = None,
    whole_rows: bool = False,
) -> DataFrame:
    """Occurrences of a term in the corpus times ln(documents / documents with the term).

    A document may be spread over many rows, such as the lines of a file; counting per term and
    document first then leaves one row for each. With ``whole_rows`` every row is a document of
    its own, and that shuffle, as large as the texts, is spared. ``documents`` is the size of the
    corpus; by default that of the different values of the ``document`` column, with documents that
    hold no word included.
    """
    if documents is None:
        documents = df.agg(F.count_distinct(document)).scalar()
    elif isinstance(documents, int):
        documents = F.lit(documents)
    terms = _document_counts(df, document, text, whole_rows)
    return terms.withColumn("weight", F.col("tf") * F.log(documents / F.col("df")))
