"""Keep tables right under increments, replays and late rows.

Three ways to maintain a rollup:

* `refresh_touched` recomputes the partitions a micro-batch touched. Exact for every
  measure and idempotent, at the cost of rereading those partitions.
* `append_partials` writes mergeable state per micro-batch and `merge_partials` finishes
  it on read. Each row is read once; exact distinct counts keep their values as rows.
* `hourly_stream` keeps windows in state and emits each hour once, when the watermark
  has passed it. Rows later than the watermark are dropped.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from mobility_lake.operators.conform import stamp
from mobility_lake.operators.dedup import dedup_events
from mobility_lake.operators.layout import lay_out, one_file_each
from mobility_lake.operators.quality import require_all
from mobility_lake.operators.rollup import (
    RollupSpec,
    distinct_ids,
    distinct_values,
    prepare,
    rollup,
    rollup_combine,
    rollup_merge,
    rollup_partial,
    with_units,
)
from mobility_lake.sources import runs
from mobility_lake.sources.lake import (
    Layout,
    lake_replace_partitions,
    path_exists,
    read_partitions,
    stored_schema,
    with_trigger,
)
from mobility_lake.sources.versions import current
from mobility_lake.streaming import key_index

HOUR = ("event_date", "event_hour")
Prepare = Callable[[DataFrame], DataFrame]
Apply = Callable[[DataFrame, int], None]

# Tables that keep each micro-batch apart have this as their last partition column.
BATCH = "batch_id"
# The batch id of what a rebuild wrote.
REBUILT = -1
# Calendar columns that say the same.
_SAME = {"event_hour": ("hour",), "hour": ("event_hour",)}
_DAY = {"year", "month", "day"}


def _known(columns: Sequence[str]) -> set[str]:
    """The columns, and the calendar columns that follow from them."""
    known = {*columns}
    for name in columns:
        known.update(_SAME.get(name, ()))
    if _DAY <= known:
        known.add("event_date")
    if "event_date" in known:
        known |= _DAY
    return known


def check_grain(grain: Sequence[str], partition_by: Sequence[str]) -> None:
    """Raise unless a partition holds nothing but whole groups of the grain.

    Otherwise replacing the partition would delete groups that were not recomputed.
    """
    missing = set(grain) - _known(partition_by)
    if missing:
        raise ValueError(
            f"partitions by {list(partition_by)} hold more than a group of {list(grain)}: "
            f"{sorted(missing)} must be a partition column"
        )


def only_touched(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    partition_by: Sequence[str],
    schema: T.StructType,
    grain: Sequence[str] | None = None,
    time_column: str | None = None,
) -> DataFrame | None:
    """Rows of the table in the groups that `batch` has rows for; None if there are none.

    The touched partitions are named by their folders, so neither the listing nor the scan grows
    with the table. A `grain` finer than the partitions is a semi-join on top. With `time_column`
    the rows are cut to the time span of the batch, which skips files of a
    partition that is still being appended to.
    """
    rows = require_all(batch, partition_by)
    if time_column:
        span = [F.min(time_column).alias("_low"), F.max(time_column).alias("_high")]
        found = rows.groupBy(*partition_by).agg(*span).collect()
    else:
        found = rows.select(*partition_by).distinct().collect()
    partitions = [tuple(row[name] for name in partition_by) for row in found]
    table = read_partitions(spark, path, partition_by, partitions, schema)
    if table is None:
        return None
    if time_column:
        low, high = min(row["_low"] for row in found), max(row["_high"] for row in found)
        table = table.filter(F.col(time_column).between(F.lit(low), F.lit(high)))
    if grain and set(grain) - set(partition_by):
        table = table.join(distinct_values(batch, grain), list(grain), "left_semi")
    return table


def start(
    stream: DataFrame,
    apply: Apply,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Run `apply` on every micro-batch that has rows. The batch is kept, so it is read once."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if not batch.isEmpty():
                apply(batch, batch_id)
        finally:
            batch.unpersist()

    writer = (
        stream.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(on_batch)
    )
    if name:
        writer = writer.queryName(name)
    return with_trigger(writer, trigger).start()


def refuse_other_checkpoint(spark: SparkSession, path: str, checkpoint: str) -> None:
    """A new checkpoint would number batches from 0 again and replace the ones that are there."""
    if stored_schema(spark, path) is not None and not path_exists(spark, f"{checkpoint}/metadata"):
        raise ValueError(f"{path} holds batches of another checkpoint")


def by_batch(path: str, partition_by: Sequence[str] = (), layout: Layout = lay_out) -> Apply:
    """Write each micro-batch to partitions of its own: a retried batch replaces itself.

    There is no sink log beside the data, so a rebuild can replace the table under the stream.
    """
    columns = [*partition_by, BATCH]

    def apply(batch: DataFrame, batch_id: int) -> None:
        lake_replace_partitions(batch.withColumn(BATCH, F.lit(batch_id)), path, columns, layout)

    return apply


def rolled_rows(
    rows: DataFrame,
    spec: RollupSpec,
    prepare_rows: Prepare | None = None,
    dedup_keys: Sequence[str] = (),
    dedup_order: Sequence[str] = (),
    process_ts: str | None = None,
) -> DataFrame:
    """A rollup of table rows, the same in a refresh and in a rebuild."""
    if dedup_keys:
        rows = dedup_events(rows, dedup_keys, dedup_order)
    if prepare_rows:
        rows = prepare_rows(rows)
    rolled = rollup(rows, spec)
    return stamp(rolled, process_ts) if process_ts else rolled


def refresh_touched(
    stream: DataFrame,
    spec: RollupSpec,
    silver: str,
    gold: str,
    checkpoint: str,
    grain: Sequence[str] = HOUR,
    partition_by: Sequence[str] = HOUR,
    schema: T.StructType | None = None,
    silver_partitions: Sequence[str] | None = None,
    prepare_rows: Prepare | None = None,
    dedup_keys: Sequence[str] = (),
    dedup_order: Sequence[str] = (),
    process_ts: str | None = None,
    finish: Prepare | None = None,
    trigger: Mapping[str, object] | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Recompute the `grain` groups of `silver` that each micro-batch touched.

    `stream` reads the same table and only says which groups changed; the numbers come from the
    table, so late rows, retries and replays all end in the same result. `silver_partitions` are its
    partition columns (the grain, if they are the same). A partition of the result must not hold
    more than a group of the grain; otherwise this raises. With `dedup_keys` the recompute
    also deduplicates, which never loses a late row and needs no state. `process_ts` names
    a column for the processing time; `finish` shapes the rows before they are written.
    """
    check_grain(grain, partition_by)
    schema = schema or stored_schema(stream.sparkSession, silver) or stream.schema
    stored_by = tuple(silver_partitions or grain)
    version = current(stream.sparkSession, silver)

    def apply(batch: DataFrame, batch_id: int) -> None:
        if current(batch.sparkSession, silver) != version:
            raise RuntimeError(f"{silver} was rebuilt: start this query again to read its new version")
        rows = only_touched(batch.sparkSession, silver, batch, stored_by, schema, grain)
        if rows is None:
            return
        rolled = rolled_rows(rows, spec, prepare_rows, dedup_keys, dedup_order, process_ts)
        if finish:
            rolled = finish(rolled)
        lake_replace_partitions(rolled, gold, partition_by, one_file_each)

    return start(stream, apply, checkpoint, trigger, name)


def append_partials(
    stream: DataFrame,
    spec: RollupSpec,
    path: str,
    checkpoint: str,
    prepare_rows: Prepare | None = None,
    trigger: Mapping[str, object] | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Write mergeable partial rows per micro-batch, each as a run of the table.

    A retried batch replaces its run. A new checkpoint would number batches from 0 again and mix with
    the old ones, so it is refused while the table holds data. `compact_partials` keeps the number of
    runs down.
    """
    spark = stream.sparkSession
    if runs.live(spark, path) and not path_exists(spark, f"{checkpoint}/metadata"):
        raise ValueError(f"{path} holds batches of another checkpoint")

    def apply(batch: DataFrame, batch_id: int) -> None:
        rows = prepare_rows(batch) if prepare_rows else batch
        states = rollup_partial(rows, spec), distinct_ids(rows, spec)
        runs.add(batch.sparkSession, path, batch_id, lambda folder: _write_partials(*states, spec, folder))

    return start(stream, apply, checkpoint, trigger, name)


def _write_partials(partials: DataFrame, ids: DataFrame | None, spec: RollupSpec, folder: str) -> None:
    """A run of partial rows, in the order of their keys, so that a day's rows lie together."""
    keys = list(spec.keys)
    for inside, rows in (("sums", partials), ("ids", ids)):
        if rows is not None:
            if keys:
                rows = rows.hint("rebalance", F.col(keys[0])).sortWithinPartitions(*keys)
            rows.write.parquet(f"{folder}/{inside}")


def _partial_rows(
    spark: SparkSession, spec: RollupSpec, path: str, chosen: Sequence[runs.Run]
) -> tuple[DataFrame, DataFrame | None]:
    """(partial rows, values of exact distinct counts) of some runs."""
    sums = spark.read.parquet(*runs.folders(path, chosen, "sums"))
    has_ids = any(m.kind == "distinct" for m in spec.measures)
    return sums, spark.read.parquet(*runs.folders(path, chosen, "ids")) if has_ids else None


def merge_partials(spark: SparkSession, spec: RollupSpec, path: str) -> DataFrame:
    """The rollup that the live partial rows add up to. Only the files of live runs are read."""
    live = runs.live(spark, path)
    if not live:
        raise ValueError(f"no partial rows at {path}")
    sums, ids = _partial_rows(spark, spec, path, live)
    return rollup_merge(sums, spec, ids)


def compact_partials(spark: SparkSession, spec: RollupSpec, path: str, fan: int = runs.FAN) -> int:
    """Combine the partial rows of every level that has `fan` runs into one row per key.

    The combined run takes the place of the others in one step, so this can run again at any time, also
    beside the stream or after it was interrupted, and nothing counts twice. With `fan` 2 all
    but a few runs are combined. `versions.remove_old` clears the replaced runs away. Returns the number
    of merges.
    """

    def write(chosen: Sequence[runs.Run], folder: str) -> None:
        sums, ids = _partial_rows(spark, spec, path, chosen)
        _write_partials(rollup_combine(sums, spec), None if ids is None else ids.distinct(), spec, folder)

    return runs.merge(spark, path, write, fan=fan)


def new_rows(
    keys: Sequence[str],
    path: str,
    partition_by: Sequence[str],
    schema: T.StructType,
    order: Sequence[str] = (),
    time_column: str | None = None,
    index: str | None = None,
) -> Apply:
    """Append the rows of a micro-batch whose key the table does not hold yet.

    Copies inside the micro-batch are aggregated away first; what remains is anti-joined against the
    keys of the touched partitions, cut to the batch's time span if `time_column` is a key. That is
    all there is to do when the keys fix the partition. When they do not, `index` names an index of
    all keys (see `key_index`), and what it may hold of the batch is compared as well.

    A retried batch finds its own rows in the touched partitions and adds nothing; its run of the
    index does not count as known to itself, and is replaced.
    """
    if time_column is not None and time_column not in keys:
        raise ValueError("copies share the time column only if it is one of the keys")

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fresh = dedup_events(batch, keys, order)
        held = []
        try:
            if index is not None:
                key_index.merge(spark, keys, index, before=batch_id)
                held.append(fresh.persist())
                earlier = key_index.known(fresh, keys, index, batch_id)
                if earlier is not None:
                    fresh = fresh.join(earlier, list(keys), "left_anti").persist()
                    held.append(fresh)
            stored = only_touched(
                spark, path, batch, partition_by, schema, time_column=time_column
            )
            rows = fresh
            if stored is not None:
                rows = fresh.join(stored.select(*keys), list(keys), "left_anti")
            (
                lay_out(rows.select(*batch.columns), partition_by)
                .write.mode("append")
                .partitionBy(*partition_by)
                .parquet(current(spark, path))
            )
            if index is not None:
                key_index.add(fresh, keys, index, batch_id)
        finally:
            for kept in held:
                kept.unpersist()

    return apply


def append_new(
    stream: DataFrame,
    keys: Sequence[str],
    path: str,
    checkpoint: str,
    partition_by: Sequence[str],
    order: Sequence[str] = (),
    time_column: str | None = None,
    index: str | None = None,
    trigger: Mapping[str, object] | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Deduplication without a horizon and without state: see `new_rows`."""
    apply = new_rows(keys, path, partition_by, stream.schema, order, time_column, index)
    return start(stream, apply, checkpoint, trigger, name)


def hourly_stream(
    stream: DataFrame,
    spec: RollupSpec,
    watermark: str = "1 hour",
    event_ts: str = "event_ts",
) -> DataFrame:
    """The spec as event-time windows of one hour, for an append-mode sink.

    Streams cannot count distinct values exactly, so those measures become approximate.
    """
    others = [key for key in spec.keys if key not in HOUR]
    ready = with_units(prepare(stream.withWatermark(event_ts, watermark), spec), spec)
    present = set(ready.columns)
    measures = [
        replace(m, kind="approx") if m.kind == "distinct" else m for m in spec.measures
    ]
    hour = F.window(event_ts, "1 hour")
    windows = ready.groupBy(hour, *others).agg(*[m.full(present) for m in measures])
    keys = {
        "event_date": F.to_date("window.start").alias("event_date"),
        "event_hour": F.hour("window.start").alias("event_hour"),
    }
    return windows.select(
        *[keys.get(key, F.col(key)) for key in spec.keys], *[m.name for m in measures]
    )
