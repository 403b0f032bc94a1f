"""Small helpers shared by the tests."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

UTC = dt.timezone.utc
NOW = {"availableNow": True}


def at(text: str) -> dt.datetime:
    """UTC instant from `2024-01-01 06:00:00`."""
    return dt.datetime.fromisoformat(text).replace(tzinfo=UTC)


def one(spark, expression, **columns):
    """Value of a column expression over a single row of string columns."""
    schema = ", ".join(f"{name} string" for name in columns) or "dummy string"
    row = tuple(columns.values()) or ("x",)
    return spark.createDataFrame([row], schema).select(expression.alias("v")).first()["v"]


def text_of(spark, expression, **columns):
    """The same, as text, for timestamps."""
    return one(spark, F.date_format(expression, "yyyy-MM-dd HH:mm:ss.SSS"), **columns)


def same_rows(left, right) -> bool:
    """Equal as bags of rows, columns by name."""
    right = right.select(*left.columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def drop_stamps(df):
    return df.drop("silver_process_ts", "gold_process_ts", "ingest_ts")


def records(spark, payloads, topic="t", first_offset=0, at_time="2024-05-01 00:00:00"):
    """Broker records from JSON texts."""
    rows = [
        (str(i).encode(), text.encode(), topic, 0, first_offset + i, at(at_time))
        for i, text in enumerate(payloads)
    ]
    from mobility_lake.contracts import RECORD

    return spark.createDataFrame(rows, RECORD)
