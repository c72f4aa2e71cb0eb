"""Rows written as one XML element per line, with the values in attributes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# An attribute is a name, "=" and a value in double quotes.
ATTRIBUTE = r'([^\s"=<>/]+)\s*=\s*"([^"]*)"'


def parse_attributes(column: str | Column) -> Column:
    """Map of the attributes of a row; values stay escaped and the last of equal names counts."""
    text = F.col(column) if isinstance(column, str) else column
    names = F.regexp_extract_all(text, F.lit(ATTRIBUTE), F.lit(1))
    values = F.regexp_extract_all(text, F.lit(ATTRIBUTE), F.lit(2))
    pairs = F.arrays_zip(names.alias("key"), values.alias("value"))
    last = F.filter(
        pairs, lambda pair, i: ~F.array_contains(F.slice(names, i + F.lit(2), F.size(names)), pair["key"])
    )
    repeated = F.size(F.array_distinct(names)) < F.size(names)
    return F.when(repeated, F.map_from_entries(last)).otherwise(F.map_from_arrays(names, values))


def read_attribute_rows(spark: SparkSession, path) -> DataFrame:
    """Lines that hold a row, with the line as ``value`` and its ``attributes``."""
    lines = spark.read.text(path).filter(F.ltrim("value").startswith("<row"))
    return lines.withColumn("attributes", parse_attributes("value"))


def project_fields(df: DataFrame, fields: Mapping[str, str], *, unescape=None) -> DataFrame:
    """Typed columns of the named attributes; text that is no such value becomes null.

    ``unescape`` is a function applied to string fields, such as ``unescape_html``.
    """

    def field(name: str, kind: str) -> Column:
        value = F.try_element_at("attributes", F.lit(name))
        if kind == "string":
            return unescape(value) if unescape else value
        return value.try_cast(kind)

    return df.select(*[field(name, kind).alias(name) for name, kind in fields.items()])


def parse_elements(column: str | Column, fields: Sequence[str]) -> Column:
    """Struct of the named attributes by full XML rules: entities are resolved, a broken row is null."""
    schema = StructType([StructField(f"_{name}", StringType()) for name in fields])
    parsed = F.from_xml(column, schema, {"mode": "PERMISSIVE"})
    return F.struct(*[parsed[f"_{name}"].alias(name) for name in fields])


def escape_xml(value: Column) -> Column:
    """Text as it may stand in an attribute."""
    for sign, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("\n", "&#10;"), ("\r", "&#13;")):
        value = F.replace(value, F.lit(sign), F.lit(entity))
    return value


def attributes_text(values: Mapping[str, Column], *, escaped: bool = False) -> Column:
    """``k="v" k="v"`` of the values that are not null."""
    texts = {name: value.cast("string") for name, value in values.items()}
    parts = [
        F.concat(F.lit(f'{name}="'), text if escaped else escape_xml(text), F.lit('"')) for name, text in texts.items()
    ]
    return F.concat_ws(" ", *parts)


def attribute_row(columns: Sequence[str], *, tail: str = "/>", escaped: bool = False) -> Column:
    """``<row k="v" ... />`` from columns."""
    return F.concat(
        F.lit("<row "), attributes_text({c: F.col(c) for c in columns}, escaped=escaped), F.lit(f" {tail}")
    )


def nested_element(
    parent: str,
    attributes: Sequence[str],
    children: str,
    child: str,
    child_attributes: Sequence[str],
    *,
    escaped: bool = False,
) -> Column:
    """One-line element of a parent with an element for each of its children."""

    def start(tag: str, values: Mapping[str, Column]) -> Column:
        return F.concat(F.lit(f"<{tag} "), attributes_text(values, escaped=escaped))

    def element(item: Column) -> Column:
        return F.concat(start(child, {c: item[c] for c in child_attributes}), F.lit("/>"))

    body = F.array_join(F.transform(children, element), "")
    opening = start(parent, {c: F.col(c) for c in attributes})
    return F.when(F.size(children) == 0, F.concat(opening, F.lit("/>"))).otherwise(
        F.concat(opening, F.lit(">"), body, F.lit(f"</{parent}>"))
    )
