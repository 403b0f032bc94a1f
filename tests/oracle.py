"""Compare a query with its SQL twin, the way the driver does: columns by name, rows as a bag."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.sql("set timezone = 'UTC'")
    for name in TABLES:
        connection.sql(f"create view {name} as select * from '{sf}/{name}.parquet'")
    return connection


def _value(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, decimal.Decimal):
        return f"decimal {value}"
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_value(row[i]) for i in order) for row in rows), key=repr)


_TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
    "BOOLEAN": "boolean",
}


def compare(spark_df: DataFrame, connection, sql: str) -> tuple[list, list, dict]:
    """(rows only in Spark, rows only in SQL, columns whose types differ)."""
    relation = connection.sql(sql)
    names, types = relation.columns, [str(t) for t in relation.types]
    ours = dict(spark_df.dtypes)
    wrong = {
        name: (ours.get(name), kind)
        for name, kind in zip(names, types)
        if ours.get(name) != _TYPES.get(kind, kind)
    }
    if set(names) != set(ours):
        return [sorted(ours)], [sorted(names)], wrong
    left = _bag(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    right = _bag(names, relation.fetchall())
    if left == right:
        return [], [], wrong
    from collections import Counter

    a, b = Counter(left), Counter(right)
    return list((a - b).elements()), list((b - a).elements()), wrong
