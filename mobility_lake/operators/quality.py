"""Row filters that keep a reason, and one-pass table checks."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASON = "reject_reason"


def _all_present(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in columns])


def _any_present(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(name).isNotNull() for name in columns])


def require_all(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a value in every one of the columns."""
    return df.filter(_all_present(columns)) if columns else df


def require_any(df: DataFrame, always: Sequence[str], any_of: Sequence[str]) -> DataFrame:
    """Rows with a value in all of `always` and in at least one of `any_of`."""
    return require_all(df, always).filter(_any_present(any_of))


def missing(*columns: str) -> Column:
    """Rule: at least one of the columns is NULL."""
    return ~_all_present(columns)


def missing_every(*columns: str) -> Column:
    """Rule: all of the columns are NULL."""
    return ~_any_present(columns)


def with_reason(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add `reject_reason`: the first rule that holds for the row, NULL for a good row."""
    reasons = [F.when(rule, F.lit(reason)) for reason, rule in rules.items()]
    return df.withColumn(REASON, F.coalesce(*reasons, F.lit(None).cast("string")))


def accepted(df: DataFrame) -> DataFrame:
    return df.filter(F.col(REASON).isNull()).drop(REASON)


def rejected(df: DataFrame) -> DataFrame:
    return df.filter(F.col(REASON).isNotNull())


def split_rejects(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows with their reason)."""
    marked = with_reason(df, rules)
    return accepted(marked), rejected(marked)


def between_days(
    df: DataFrame,
    start: dt.date | None = None,
    end: dt.date | None = None,
    column: str = "date",
) -> DataFrame:
    """Inclusive date range; without both ends the full range is kept.

    The column stays bare, so the range reaches the scan as a partition or row-group filter.
    """
    if start is None or end is None:
        return df
    return df.filter(F.col(column).between(F.lit(start), F.lit(end)))


def complete_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The chosen columns, without rows that miss one of them."""
    return df.select(*columns).dropna(subset=list(columns))


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Failing rows per column: (column_name, failing_rows), in one pass over the table."""
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])
    pairs = [F.struct(F.lit(name).alias("column_name"), F.col(name).alias("failing_rows"))
             for name in columns]
    return counts.select(F.inline(F.array(*pairs)))


def check_row_count(df: DataFrame) -> DataFrame:
    """Number of rows as `total_records`."""
    return df.agg(F.count("*").alias("total_records"))


def count_rows(df: DataFrame, name: str) -> DataFrame:
    """Count rows while they pass; a stream reports `rows` in its progress under `name`.

    For sinks that run the plan once per micro-batch, which `foreachBatch` need not.
    """
    return df.observe(name, F.count(F.lit(1)).alias("rows"))
