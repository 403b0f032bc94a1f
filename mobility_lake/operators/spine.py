"""Hour spines and the gaps in a series."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _hours(start: dt.datetime, end: dt.datetime) -> Column:
    first = F.date_trunc("hour", F.lit(start).cast("timestamp"))
    last = F.date_trunc("hour", F.lit(end).cast("timestamp"))
    return F.sequence(first, last, F.expr("interval 1 hour"))


def hour_spine(spark: SparkSession, start: dt.datetime, end: dt.datetime) -> DataFrame:
    """Every full hour from `start` to `end`, inclusive, as `hour_ts`."""
    return spark.range(1).select(F.explode(_hours(start, end)).alias("hour_ts"))


def missing_hours(
    df: DataFrame,
    start: dt.datetime,
    end: dt.datetime,
    keys: Sequence[str] = (),
    event_ts: str = "event_ts",
) -> DataFrame:
    """Hours of the spine without an event, per key: (keys..., hour_ts).

    The spine is folded into the aggregate, so there is no join: the distinct (key, hour)
    pairs are found by a hash aggregate, map-side first, and only they are collected. That set is
    bounded by the length of the spine, however many events a key has.
    """
    hour = F.date_trunc("hour", F.col(event_ts))
    spine = _hours(start, end)
    inside = F.when(hour.between(spine[0], F.element_at(spine, -1)), hour)
    hours = df.select(*keys, inside.alias("_hour")).distinct()
    gaps = hours.groupBy(*keys).agg(F.array_except(spine, F.collect_set("_hour")).alias("_gaps"))
    return gaps.select(*keys, F.explode("_gaps").alias("hour_ts"))
