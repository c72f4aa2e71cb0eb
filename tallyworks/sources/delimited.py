"""Comma-separated text with a known header and no quoting."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_delimited(spark: SparkSession, path, fields: Mapping[str, str]) -> DataFrame:
    """Rows of the named fields, with their types.

    Quotes are data. A short row lacks its last fields, a long one loses the surplus, and a value
    that is not of its type is null. A line whose first cell is the first name is a header,
    wherever it stands.
    """
    names = list(fields)
    schema = StructType([StructField(name, StringType()) for name in names])
    rows = spark.read.schema(schema).options(header=False, mode="PERMISSIVE", quote="").csv(path)
    data = rows.filter(~F.col(f"`{names[0]}`").eqNullSafe(names[0]))
    return data.select(
        *[
            F.col(f"`{name}`") if kind == "string" else F.col(f"`{name}`").try_cast(kind).alias(name)
            for name, kind in fields.items()
        ]
    )


def read_cells(spark: SparkSession, path, fields: Mapping[str, str]) -> DataFrame:
    """As ``read_delimited``, with an empty cell told apart from a missing one: it is the empty text, or null where its
    type has no empty value. Only cells beyond the end of a short row are missing.
    """
    names = list(fields)
    cells = spark.read.text(path).select(F.split("value", ",", -1).alias("_cells"))
    data = cells.filter(F.get("_cells", F.lit(0)) != names[0])
    values = [F.get("_cells", F.lit(i)) for i in range(len(names))]
    return data.select(*[(v if kind == "string" else v.try_cast(kind)).alias(n) for v, (n, kind) in zip(values, fields.items(), strict=True)])
