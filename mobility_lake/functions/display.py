"""Locale display as a column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def format_br(value: Column, decimals: int = 0, prefix: str = "") -> Column:
    """`1234.56` as `1.234,56`, with an optional prefix such as `R$ `; `-` when missing."""
    number = value.cast("double")
    text = F.concat(F.lit(prefix), F.translate(F.format_number(number, decimals), ",.", ".,"))
    return F.when(number.isNull() | F.isnan(number), F.lit("-")).otherwise(text)
