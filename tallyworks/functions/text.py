"""Text functions. All are built-in column expressions, so they stay inside the JVM."""

from __future__ import annotations

import re
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sixteen words left out of the split word count, and the four counted alone.
STOPWORDS = (
    "a", "is", "am", "have", "are", "was", "were", "has",
    "had", "an", "i", "he", "she", "it", "they", "there",
)
LISTED_WORDS = ("a", "is", "am", "have")

#: Delimiters of the raw tokenizer: blank, tab, line feed, carriage return, form feed.
RAW_DELIMITERS = r"[ \t\n\r\f]+"


def _as_column(column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def _named_entities() -> Column:
    """Map of the HTML 4 names to their characters, written as one literal to keep plans small."""
    listed = " ".join(f"{name}={chr(point)}" for name, point in sorted(name2codepoint.items()))
    return F.str_to_map(F.lit(listed), F.lit(" "), F.lit("="))


def _from_code_point(point: Column) -> Column:
    """Character of a code point; a lone surrogate cannot be encoded and becomes ``?``."""
    surrogate = point.between(0xD800, 0xDFFF)
    safe = F.when(surrogate, F.lit(0x3F)).otherwise(point)
    return F.decode(F.unhex(F.lpad(F.hex(safe), 8, "0")), "UTF-32")


def unescape_html(column) -> Column:
    """Resolve HTML 4 entities and numeric references up to U+FFFF in one pass.

    A reference runs from ``&`` to the next ``;`` with no other ``&`` between; unknown ones
    stay as they are. Texts without ``&`` skip the work.
    """
    text = _as_column(column)
    names = _named_entities()

    def numeric(reference: Column) -> Column:
        decimal = F.regexp_extract(reference, r"^&#([0-9]+);$", 1)
        hexadecimal = F.regexp_extract(reference, r"^&#[xX]0*([0-9a-fA-F]{1,7});$", 1)
        point = F.when(decimal != "", decimal.try_cast("int")).when(
            hexadecimal != "", F.conv(hexadecimal, 16, 10).cast("int")
        )
        return F.when(point <= 0xFFFF, _from_code_point(point)).otherwise(reference)

    def named(reference: Column) -> Column:
        name = F.regexp_extract(reference, r"(?s)^&([^&;]*);$", 1)
        return F.coalesce(F.try_element_at(names, name), reference)

    def resolve(piece: Column) -> Column:
        # most pieces are plain text, so the costly branches come behind cheap tests
        closed = piece.endswith(";")
        return (
            F.when(closed & piece.startswith("&#"), numeric(piece))
            .when(closed & piece.startswith("&"), named(piece))
            .otherwise(piece)
        )

    pieces = F.regexp_extract_all(text, F.lit(r"(?s)(&[^&;]*;|[^&]+|&)"), F.lit(1))
    has_reference = F.contains(text, F.lit("&")) & text.rlike("&[^&;]*;")
    return F.when(has_reference, F.array_join(F.transform(pieces, resolve), "")).otherwise(text)


def clean_text(column, *, unescape: bool = True, lower_again: bool = False) -> Column:
    """Lower-case, resolve entities, drop single quotes; letters are told apart by the split."""
    text = F.lower(_as_column(column))
    if unescape:
        text = unescape_html(text)
    if lower_again:
        text = F.lower(text)
    return F.replace(text, F.lit("'"), F.lit(""))


def letter_tokens(column, **options) -> Column:
    """Array of the ASCII-letter words of a text, empty ones left out."""
    return F.filter(F.split(clean_text(column, **options), "[^a-zA-Z]+"), lambda w: w != "")


def explode_words(df: DataFrame, text, *, keep=(), word: str = "word", **options) -> DataFrame:
    """One row per word of ``text``, with the columns in ``keep``.

    The text is cleaned in a projection of its own, which leaves the generator and what follows it
    to generated code.
    """
    cleaned = df.select(*keep, clean_text(text, **options).alias("_clean"))
    words = cleaned.select(*keep, F.explode(F.split("_clean", "[^a-zA-Z]+")).alias(word))
    return words.filter(F.col(word) != "")


def stopword_tokens(df: DataFrame, text, *, word: str = "word") -> DataFrame:
    """Distinct words of a stopword text: lower case, quotes removed, split at white space."""
    cleaned = F.replace(F.lower(_as_column(text)), F.lit("'"), F.lit(""))
    words = df.select(F.explode(F.split(cleaned, RAW_DELIMITERS)).alias(word))
    return words.filter(F.col(word) != "").distinct()


def raw_tokens(column) -> Column:
    """Distinct tokens in their own case: white-space split, quotes removed, other signs to blanks.

    A sign inside a token leaves a blank inside it, and a token of signs alone is kept as blanks.
    Quotes go and the text is split first, so that only its different tokens are cleaned, and only those with other signs.
    """
    tokens = F.array_distinct(F.split(F.replace(_as_column(column), F.lit("'"), F.lit("")), RAW_DELIMITERS))
    cleaned = F.transform(tokens, lambda t: F.when(t.rlike("[^a-zA-Z]"), F.regexp_replace(t, "[^a-zA-Z]", " ")).otherwise(t))
    return F.array_remove(F.array_distinct(cleaned), "")


def first_link(column, prefix: str) -> Column:
    """First double-quoted string starting with ``prefix``, cut at ``#``; null when there is none."""
    pattern = f'"({re.escape(prefix)}[^"#]*)[^"]*"'
    return F.nullif(F.regexp_extract(_as_column(column), pattern, 1), F.lit(""))


def tag_list(column) -> Column:
    """Tags of an escaped ``<a><b>`` text, in lower case."""
    tags = F.split(unescape_html(column), "><")
    return F.transform(tags, lambda t: F.lower(F.regexp_replace(t, "[<>]", "")))
