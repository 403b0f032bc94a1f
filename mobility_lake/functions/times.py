"""Event-time expressions. All assume the session zone is UTC (see `session.pin`)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_event_time(text: Column, patterns: Sequence[str] = ()) -> Column:
    """Text to timestamp; NULL when no spelling fits, never an error.

    The cast reads every spelling the feeds use: `T` or a space between date and time,
    any number of decimals, `Z`, `+03`, `+0300` and `+03:00` offsets or none (then UTC).
    `patterns` are tried in order on what it could not read; keep them few, a pattern
    that does not fit costs an exception per row.

    A bare time of day is refused: the cast would complete it with today's date and a
    replay would give another result.
    """
    text = F.trim(text)
    time_only = F.instr(text, ":").between(1, 4)
    by_cast = F.when(~time_only, text.try_cast("timestamp"))
    return F.coalesce(by_cast, *[F.try_to_timestamp(text, F.lit(p)) for p in patterns])


def iso_utc(ts: Column) -> Column:
    """Timestamp to `2024-01-31T06:00:00Z` text, cut to whole seconds."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def day_of(ts: Column) -> Column:
    """Calendar day of a timestamp."""
    return F.to_date(ts)


def date_from_parts(year: Column, month: Column, day: Column) -> Column:
    """Date from its parts; NULL when they name no calendar day."""
    parts = [c.try_cast("int") for c in (year, month, day)]
    zero = F.lit(0)
    return F.try_make_timestamp(*parts, zero, zero, zero).cast("date")
