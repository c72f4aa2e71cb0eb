"""Comparison of a Spark result with the SQL result, as multisets of normalized rows."""

from __future__ import annotations

import datetime
import decimal
from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return int(value) if value == int(value) else value
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def connect(sf_dir: str):
    import duckdb

    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def spark_rows(df):
    return _rows(df.columns, [tuple(row) for row in df.collect()])


def sql_rows(db, sql):
    cursor = db.execute(sql)
    return _rows([d[0] for d in cursor.description], cursor.fetchall())


def differences(df, db, sql):
    """Empty text when equal, else what differs."""
    (columns, mine), (names, theirs) = spark_rows(df), sql_rows(db, sql)
    if columns != names:
        return f"columns {columns} != {names}"
    if mine != theirs:
        extra, missing = mine - theirs, theirs - mine
        return f"{sum(mine.values())} rows, {sum(theirs.values())} expected; extra {list(extra)[:3]}; missing {list(missing)[:3]}"
    return ""
