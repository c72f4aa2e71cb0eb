"""Timestamps in text form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: text form of a timestamp.
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS"
TIMESTAMP_PATTERN = r"\A\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{3}\z"


def parse_moment(column) -> Column:
    """Timestamp without zone, or null when the text cannot be read."""
    text = F.col(column) if isinstance(column, str) else column
    # a cast that never passes through the zone of the session; it alone would take other forms as well
    return F.when(text.rlike(TIMESTAMP_PATTERN), text.try_cast("timestamp_ntz"))


def format_moment(column) -> Column:
    return F.date_format(column, TIMESTAMP_FORMAT)


def day_text(column) -> Column:
    """Part of a timestamp text before its ``T``; a text without ``T`` stays whole."""
    return F.substring_index(column, "T", 1)
