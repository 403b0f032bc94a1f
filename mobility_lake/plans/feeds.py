"""The five feeds end to end: which function builds each table, and how it is kept up to date."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from mobility_lake import contracts
from mobility_lake.catalog import Lake
from mobility_lake.operators.conform import event_date_from_parts
from mobility_lake.operators.dedup import dedup_events
from mobility_lake.operators.layout import one_file_each
from mobility_lake.operators.quality import REASON, accepted, count_rows, rejected
from mobility_lake.operators.rollup import RollupSpec
from mobility_lake.plans import gold
from mobility_lake.plans.bronze import BRONZE
from mobility_lake.plans.marts import stage_traffic
from mobility_lake.plans.silver import MARK
from mobility_lake.sources.landing import load_by_name
from mobility_lake.sources.lake import lake_append_stream, lake_read, lake_rebuild, lake_stream
from mobility_lake.streaming.incremental import (
    BATCH,
    REBUILT,
    by_batch,
    new_rows,
    refresh_touched,
    refuse_other_checkpoint,
    rolled_rows,
    start,
)
from mobility_lake.streaming import key_index


@dataclass(frozen=True)
class Feed:
    """What is particular about one feed.

    `grain` is what a rollup refresh recomputes: an hour, also where partitions are days.
    """

    name: str
    silver_partitions: tuple[str, ...]
    grain: tuple[str, ...]
    specs: tuple[RollupSpec, ...]
    dedup_keys: tuple[str, ...] = ()
    dedup_order: tuple[str, ...] = ()
    prepare: Mapping[str, Callable[[DataFrame], DataFrame]] | None = None

    def prepared(self, spec: RollupSpec) -> Callable[[DataFrame], DataFrame] | None:
        return (self.prepare or {}).get(spec.name)


FEEDS = {
    feed.name: feed
    for feed in (
        Feed(
            "trips",
            ("year", "month", "day"),
            ("year", "month", "day", "hour"),
            (gold.TRIPS_HOURLY, gold.TRIPS_YMDH),
            dedup_keys=("trip_id", "event_ts"),
            dedup_order=("ingest_ts",),
            prepare={"trips_hourly": event_date_from_parts},
        ),
        Feed("gps", gold.HOUR, gold.HOUR, (gold.GPS_HOURLY, gold.GPS_MOBILITY_HOURLY)),
        Feed("weather", gold.HOUR, gold.HOUR, (gold.WEATHER_HOURLY, gold.WEATHER_CONDITION_HOURLY)),
        Feed(
            "traffic",
            gold.HOUR,
            gold.HOUR,
            (gold.TRAFFIC_HOURLY,),
            dedup_keys=("event_id",),
            dedup_order=("ingest_ts", "partition", "offset"),
        ),
        Feed(
            "incidents",
            gold.HOUR,
            gold.HOUR,
            (gold.INCIDENTS_HOURLY, gold.INCIDENTS_DETAIL_HOURLY),
            dedup_keys=("incident_id", "event_ts"),
            prepare={"incidents_hourly": gold.clean_incidents},
        ),
    )
}

Trigger = Mapping[str, object] | None
# Rollups whose landing table has another name.
LANDS_AS = {gold.TRIPS_YMDH.name: gold.TRIPS_HOURLY.name}
PROCESS_TS = "gold_process_ts"


def gold_partitions(spec: RollupSpec) -> tuple[str, ...]:
    """Rollups are stored by hour, so that a refresh replaces no more than it recomputed."""
    parts = ("year", "month", "day", "hour")
    return parts if set(parts) <= set(spec.keys) else gold.HOUR


def start_bronze(
    records: DataFrame, lake: Lake, feed: str, trigger: Trigger = None
) -> StreamingQuery:
    """Append broker records to the bronze table. No shuffle: each task writes its own files.

    The progress reports the rows written as the metric `bronze-<feed>`.
    """
    return lake_append_stream(
        count_rows(BRONZE[feed](records), f"bronze-{feed}"),
        lake.table("bronze", feed),
        lake.checkpoint("bronze", feed),
        ("event_date",),
        trigger,
        f"bronze-{feed}",
    )


def _has_index(plan: Feed) -> bool:
    """Whether the keys leave the event time open, so that a repeat may lie in another partition."""
    return bool(plan.dedup_keys) and "event_ts" not in plan.dedup_keys


def stored_silver(feed: str) -> T.StructType:
    """The columns of the stored table: feeds without dedup keys keep their batches apart."""
    schema = contracts.SILVER[feed]
    if FEEDS[feed].dedup_keys:
        return schema
    return T.StructType([*schema.fields, T.StructField(BATCH, T.IntegerType())])


def start_silver(
    spark: SparkSession,
    lake: Lake,
    feed: str,
    trigger: Trigger = None,
    max_files: int | None = 50,
    horizon: str | None = None,
    rejects: bool = False,
    now_if_missing: bool = False,
) -> StreamingQuery:
    """Conform new bronze files into the silver table.

    Feeds with dedup keys are deduplicated against the table itself, without a horizon: the touched
    partitions where the event time is part of the key, and otherwise also an index of all
    keys, whose filters tell which of its parts may hold a key of the micro-batch.
    With `horizon` the repeats are dropped in stream state instead, which reads nothing
    back but treats later repeats as late rows.

    With `rejects` the rows that are left out go to the rejects table in the same pass.
    No table has a sink log, so `rebuild_silver` may replace it while this stream is stopped.
    """
    plan = FEEDS[feed]
    bronze = lake_stream(
        spark, lake.table("bronze", feed), contracts.BRONZE[feed], max_files=max_files
    )
    marked = MARK[feed](bronze, now_if_missing=now_if_missing)
    path, checkpoint = lake.table("silver", feed), lake.checkpoint("silver", feed)
    if plan.dedup_keys:
        write = new_rows(
            plan.dedup_keys,
            path,
            plan.silver_partitions,
            contracts.SILVER[feed],
            plan.dedup_order,
            time_column="event_ts" if "event_ts" in plan.dedup_keys else None,
            index=lake.table("index", feed) if _has_index(plan) else None,
        )
    else:
        refuse_other_checkpoint(spark, path, checkpoint)
        write = by_batch(path, plan.silver_partitions)
    if plan.dedup_keys and horizon is not None:
        if rejects:
            raise ValueError("rejects need the whole micro-batch, a horizon drops rows before it")
        marked = dedup_events(marked.filter(F.col(REASON).isNull()), plan.dedup_keys, horizon=horizon)
    write_rejects = by_batch(lake.table("rejects", feed))

    def apply(batch: DataFrame, batch_id: int) -> None:
        write(accepted(batch), batch_id)
        if rejects:
            write_rejects(rejected(batch), batch_id)

    return start(marked, apply, checkpoint, trigger, f"silver-{feed}")


def start_rejects(
    spark: SparkSession, lake: Lake, feed: str, trigger: Trigger = None
) -> StreamingQuery:
    """Append the rows silver leaves out, with their reason, where silver does not do so itself.

    This reads bronze a second time; `start_silver(..., rejects=True)` does not.
    """
    bronze = lake_stream(spark, lake.table("bronze", feed), contracts.BRONZE[feed])
    return lake_append_stream(
        rejected(MARK[feed](bronze)),
        lake.table("rejects", feed),
        lake.checkpoint("rejects", feed),
        trigger=trigger,
        name=f"rejects-{feed}",
    )


def start_gold(
    spark: SparkSession,
    lake: Lake,
    feed: str,
    spec: RollupSpec,
    trigger: Trigger = None,
    max_files: int | None = 50,
) -> StreamingQuery:
    """Keep one rollup of a feed exact while silver grows."""
    return _refresh(spark, lake, feed, spec, "gold", trigger, max_files)


def start_landing(
    spark: SparkSession,
    lake: Lake,
    feed: str,
    spec: RollupSpec,
    trigger: Trigger = None,
    max_files: int | None = 50,
) -> StreamingQuery:
    """Keep the landing table of a rollup exact while silver grows.

    Hours are replaced, not added to, so a second refresh of an hour does not count twice.
    """
    return _refresh(spark, lake, feed, spec, "landing", trigger, max_files)


def _refresh(
    spark: SparkSession,
    lake: Lake,
    feed: str,
    spec: RollupSpec,
    layer: str,
    trigger: Trigger,
    max_files: int | None,
) -> StreamingQuery:
    plan = FEEDS[feed]
    silver = lake.table("silver", feed)
    partitions = gold_partitions(spec)

    def landed(rolled: DataFrame) -> DataFrame:
        return landing_rows(rolled, LANDS_AS.get(spec.name, spec.name), keep=partitions)

    return refresh_touched(
        lake_stream(spark, silver, stored_silver(feed), max_files=max_files),
        spec,
        silver,
        lake.table(layer, spec.name),
        lake.checkpoint(layer, spec.name),
        grain=plan.grain,
        partition_by=partitions,
        schema=contracts.SILVER[feed],
        silver_partitions=plan.silver_partitions,
        finish=landed if layer == "landing" else None,
        trigger=trigger,
        name=f"{layer}-{spec.name}",
        **_roll_options(plan, spec),
    )


def _roll_options(plan: Feed, spec: RollupSpec) -> dict:
    """How rows become a rollup, for a refresh and for a rebuild."""
    return {
        "prepare_rows": plan.prepared(spec),
        # A silver written with a horizon can hold repeats that came later than it.
        "dedup_keys": plan.dedup_keys,
        "dedup_order": plan.dedup_order,
        "process_ts": PROCESS_TS,
    }


def silver_batch(
    spark: SparkSession, lake: Lake, feed: str, now_if_missing: bool = False
) -> DataFrame:
    """The whole silver table, computed from bronze."""
    plan = FEEDS[feed]
    bronze = lake_read(spark, lake.table("bronze", feed), contracts.BRONZE[feed])
    good = accepted(MARK[feed](bronze, now_if_missing=now_if_missing))
    return dedup_events(good, plan.dedup_keys, plan.dedup_order) if plan.dedup_keys else good


def rebuild_silver(
    spark: SparkSession, lake: Lake, feed: str, now_if_missing: bool = False
) -> None:
    """Replace silver from bronze, and its key index. The silver stream must be stopped meanwhile.

    It goes on where it stopped: bronze that it has not read yet must not be in a rebuild of a feed
    without dedup keys, so let it catch up first.
    """
    plan, path = FEEDS[feed], lake.table("silver", feed)
    rows = silver_batch(spark, lake, feed, now_if_missing)
    if plan.dedup_keys:
        lake_rebuild(rows, path, plan.silver_partitions)
    else:
        rows = rows.withColumn(BATCH, F.lit(REBUILT))
        lake_rebuild(rows, path, (*plan.silver_partitions, BATCH))
    if _has_index(plan):
        stored = lake_read(spark, path, contracts.SILVER[feed])
        key_index.rebuild(stored, plan.dedup_keys, lake.table("index", feed), REBUILT)


def rebuild_gold(spark: SparkSession, lake: Lake, feed: str, spec: RollupSpec) -> None:
    """Replace one rollup from silver. How often is up to the caller's scheduler."""
    rows = lake_read(spark, lake.table("silver", feed), contracts.SILVER[feed])
    lake_rebuild(
        rolled_rows(rows, spec, **_roll_options(FEEDS[feed], spec)),
        lake.table("gold", spec.name),
        gold_partitions(spec),
        one_file_each,
    )


def landing_rows(rolled: DataFrame, name: str, keep: Sequence[str] = ()) -> DataFrame:
    """An hourly rollup as rows of its landing table; columns without a source are NULL.

    `keep` names columns of the rollup that stay beside them, such as its partitions.
    """
    kept = {f"_{column}": F.col(column) for column in keep}
    wire = contracts.to_wire(rolled.withColumns(kept), f"gold.{name}")
    sources = contracts.LANDING_SOURCES.get(name)
    return load_by_name(
        wire, contracts.LANDING[name], sources, {column: f"_{column}" for column in keep}
    )


def landing_traffic(gold_traffic: DataFrame, gold_gps: DataFrame) -> DataFrame:
    """The traffic landing table, with the mean speed of the city's hour from GPS."""
    sources = {
        "CIDADE": "city",
        "NIVEL_CONGESTIONAMENTO": "congestion_level",
        "VELOCIDADE_MEDIA": "mean_speed",
    }
    staged = stage_traffic(gold_traffic, gold_gps)
    return load_by_name(staged, contracts.LANDING["traffic_hourly"], sources)
