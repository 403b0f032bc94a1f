"""Hours that are written once they are over, and again when rows come late.

A watermark stays `delay` behind the latest event of the micro-batches so far. An hour it has passed is
rolled up from the table; a row that comes for such an hour is late: it is counted, and its hour
is rolled up again. So nothing vanishes, no hour's rows are kept in state, and a replay ends in the same table.

What a micro-batch found is noted beside its checkpoint in one step (see `versions`): the latest event, the
hours not yet over, the late rows. A retried micro-batch starts from the note before it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from mobility_lake.operators.layout import one_file_each
from mobility_lake.operators.rollup import RollupSpec
from mobility_lake.sources import versions
from mobility_lake.sources.lake import lake_replace_partitions, read_partitions, stored_schema
from mobility_lake.streaming.incremental import HOUR, Prepare, check_grain, rolled_rows, start

_HOUR = dt.timedelta(hours=1)
_EPOCH = dt.datetime(1970, 1, 1)
_CALENDAR = {
    "event_date": dt.datetime.date,
    "event_hour": lambda at: at.hour,
    "hour": lambda at: at.hour,
    "year": lambda at: at.year,
    "month": lambda at: at.month,
    "day": lambda at: at.day,
}


def _time(micros: int) -> dt.datetime:
    return _EPOCH + dt.timedelta(microseconds=micros)


def late_rows(spark: SparkSession, checkpoint: str) -> int:
    """How many rows came for an hour that was over."""
    note = versions.state(spark, f"{checkpoint}/hours")
    return note["now"]["late"] if note else 0


def start_closed_hours(
    stream: DataFrame,
    spec: RollupSpec,
    silver: str,
    gold: str,
    checkpoint: str,
    delay: dt.timedelta = _HOUR,
    event_ts: str = "event_ts",
    schema: T.StructType | None = None,
    silver_partitions: Sequence[str] = HOUR,
    prepare_rows: Prepare | None = None,
    dedup_keys: Sequence[str] = (),
    dedup_order: Sequence[str] = (),
    trigger: Mapping[str, object] | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Keep the hours of `gold` that are over, `delay` after their end, equal to a rollup of `silver`.

    `stream` reads the same table. The driver sees a row per hour of a micro-batch; only the partitions of the
    hours to be written are read.
    """
    check_grain(HOUR, HOUR)
    if unknown := set(silver_partitions) - set(_CALENDAR):
        raise ValueError(f"partitions by {sorted(unknown)} do not follow from the hour")
    schema = schema or stored_schema(stream.sparkSession, silver) or stream.schema
    notes = f"{checkpoint}/hours"

    def write(spark: SparkSession, hours: Sequence[dt.datetime]) -> None:
        parts = {tuple(_CALENDAR[column](hour) for column in silver_partitions) for hour in hours}
        table = read_partitions(spark, silver, silver_partitions, sorted(parts), schema)
        if table is None:
            return
        wanted = spark.createDataFrame([(h.date(), h.hour) for h in hours], "event_date date, event_hour int")
        rows = table.join(wanted, list(HOUR), "left_semi")
        rolled = rolled_rows(rows, spec, prepare_rows, dedup_keys, dedup_order)
        lake_replace_partitions(rolled, gold, HOUR, one_file_each)

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        note = versions.state(spark, notes) or {}
        prior = note.get("before" if note.get("batch") == batch_id else "now") or {"latest": None, "open": [], "late": 0}
        ended = F.unix_micros(F.date_trunc("hour", event_ts))
        found = (
            batch.filter(F.col(event_ts).isNotNull())
            .groupBy(ended.alias("hour"))
            .agg(F.count("*").alias("n"), F.max(F.unix_micros(F.col(event_ts))).alias("latest"))
            .collect()
        )
        if not found:
            return
        latest = max([row["latest"] for row in found] + [prior["latest"]] * (prior["latest"] is not None))

        def is_over(hour: int, mark: int | None) -> bool:
            return mark is not None and _time(hour) + _HOUR + delay <= _time(mark)

        late = [row for row in found if is_over(row["hour"], prior["latest"])]
        seen = {*prior["open"], *[row["hour"] for row in found if not is_over(row["hour"], prior["latest"])]}
        closed = {hour for hour in seen if is_over(hour, latest)}
        todo = sorted(closed | {row["hour"] for row in late})
        if todo:
            write(spark, [_time(hour) for hour in todo])
        now = {"latest": latest, "open": sorted(seen - closed), "late": prior["late"] + sum(row["n"] for row in late)}
        versions.commit(spark, notes, lambda _: {"batch": batch_id, "before": prior, "now": now})

    return start(stream, apply, checkpoint, trigger, name)
