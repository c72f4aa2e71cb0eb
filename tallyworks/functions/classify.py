"""Classes derived from a column value."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The fifty state codes looked up in a location.
STATE_CODES = (
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA",
    "HI", "ID", "IL", "IN", "IA", "KS", "KY", "LA", "ME", "MD",
    "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ",
    "NM", "NY", "NC", "ND", "OH", "OK", "OR", "PA", "RI", "SC",
    "SF", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY",
)
# Names of the two classes for locations without a code.
UNKNOWN = "Unknown"
NULL_OR_EMPTY = "NullOrEmpty"
# Numbers standing for the three pay levels.
PAY_LEVELS = {"low": 0.0, "medium": 50.0, "high": 100.0}


def place_class(column, codes: Sequence[str] = STATE_CODES) -> Column:
    """First white-space token of the upper-cased place that is one of ``codes``."""
    place = F.col(column) if isinstance(column, str) else column
    known = F.filter(F.split(F.upper(place), r"\s"), lambda token: token.isin(*codes))
    return F.when(F.coalesce(place, F.lit("")) == "", F.lit(NULL_OR_EMPTY)).otherwise(
        F.coalesce(F.get(known, F.lit(0)), F.lit(UNKNOWN))
    )


def coded(column, codes: Mapping[str, float]) -> Column:
    """Number of a category; categories outside ``codes`` are null and so left out of averages."""
    category = F.col(column) if isinstance(column, str) else column
    number = F.lit(None).cast("double")
    for name, value in codes.items():
        number = F.when(category == name, F.lit(float(value))).otherwise(number)
    return number
