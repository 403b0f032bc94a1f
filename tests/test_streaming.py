import glob
import os

import pytest
from helpers import NOW, at, drop_stamps, same_rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entry_queries import views as v
from mobility_lake import contracts
from mobility_lake.catalog import Lake
from mobility_lake.operators.conform import stamp
from mobility_lake.operators.dedup import dedup_events
from mobility_lake.operators.joins import with_region
from mobility_lake.operators.quality import rejected
from mobility_lake.operators.rollup import RollupSpec, approx, low, mean, rollup, rows, total
from mobility_lake.plans import feeds, gold
from mobility_lake.plans.silver import MARK
from mobility_lake.sources import runs
from mobility_lake.sources.lake import (
    folder_name,
    lake_append_stream,
    lake_read,
    lake_rebuild,
    lake_stream,
)
from mobility_lake.streaming.late import late_rows, start_closed_hours
from mobility_lake.streaming.incremental import (
    append_new,
    append_partials,
    check_grain,
    compact_partials,
    hourly_stream,
    merge_partials,
    only_touched,
    refresh_touched,
)


def deliver(df, path):
    """One more file at `path`."""
    df.coalesce(1).write.mode("append").parquet(path)


def run_feed(spark, lake, feed, source, **silver):
    stream = lake_stream(spark, source, contracts.RECORD, max_files=1)
    query = feeds.start_bronze(stream, lake, feed, NOW)
    query.awaitTermination()
    seen = [p["observedMetrics"].get(f"bronze-{feed}") for p in query.recentProgress]
    feeds.start_silver(spark, lake, feed, NOW, max_files=40, **silver).awaitTermination()
    for spec in feeds.FEEDS[feed].specs:
        feeds.start_gold(spark, lake, feed, spec, NOW, max_files=200).awaitTermination()
    return sum(row["rows"] for row in seen if row)


@pytest.mark.parametrize("feed", list(feeds.FEEDS))
def test_feed_stream_equals_batch_also_after_late_and_repeated_records(spark, sf, folder, feed):
    lake, source = Lake(folder + "/lake"), folder + "/records"
    # A few hours on two days keep the number of partitions, and so of tiny files, down.
    times = "timestamp between timestamp '2024-01-01 14:00' and timestamp '2024-01-02 08:00'"
    records = v.RECORDS[feed](spark, sf).filter(times).persist()
    deliver(records.filter("offset % 5 < 2"), source)
    deliver(records.filter("offset % 5 = 2"), source)
    counted = run_feed(spark, lake, feed, source)
    # Older rows, and the second file once more.
    deliver(records.filter("offset % 5 > 2"), source)
    deliver(records.filter("offset % 5 = 2"), source)
    counted += run_feed(spark, lake, feed, source)

    bronze = lake_read(spark, lake.table("bronze", feed))
    repeated = records.filter("offset % 5 = 2").count()
    assert bronze.count() == records.count() + repeated
    silver = lake_read(spark, lake.table("silver", feed), contracts.SILVER[feed])
    batch = feeds.silver_batch(spark, lake, feed)
    keys = feeds.FEEDS[feed].dedup_keys
    assert silver.count() == batch.count()
    if keys:
        assert silver.select(*keys).distinct().count() == silver.count()
        assert same_rows(silver.select(*keys), batch.select(*keys))
    else:
        assert same_rows(drop_stamps(silver), drop_stamps(batch))
    assert counted == bronze.count()
    for spec in feeds.FEEDS[feed].specs:
        stored = lake_read(spark, lake.table("gold", spec.name))
        # From silver as stored: which copy of a repeat survives depends on its arrival.
        plan = feeds.FEEDS[feed]
        rows_in = plan.prepared(spec)(silver) if plan.prepared(spec) else silver
        assert same_rows(rollup(rows_in, spec), stored)

    feeds.start_rejects(spark, lake, feed, NOW).awaitTermination()
    marked = MARK[feed](lake_read(spark, lake.table("bronze", feed), contracts.BRONZE[feed]))
    wanted = rejected(marked).count()
    assert wanted == lake_read(spark, lake.table("rejects", feed)).count() > 0
    records.unpersist()


def test_rebuild_matches_the_stream(spark, sf, folder):
    lake, source = Lake(folder + "/lake"), folder + "/records"
    deliver(v.RECORDS["incidents"](spark, sf).filter("timestamp < timestamp '2024-01-02'"), source)
    run_feed(spark, lake, "incidents", source)
    spec = gold.INCIDENTS_HOURLY
    streamed = lake_read(spark, lake.table("gold", spec.name)).persist()
    streamed.count()
    other = Lake(folder + "/rebuilt")
    lake_rebuild(lake_read(spark, lake.table("bronze", "incidents")), other.table("bronze", "incidents"))
    feeds.rebuild_silver(spark, other, "incidents")
    feeds.rebuild_gold(spark, other, "incidents", spec)
    rebuilt = lake_read(spark, other.table("gold", spec.name))
    assert set(rebuilt.columns) == set(streamed.columns) >= {"gold_process_ts"}
    assert same_rows(drop_stamps(streamed), drop_stamps(rebuilt))
    streamed.unpersist()


def test_gold_loads_into_landing_tables(spark, sf, folder):
    trips = rollup(v.trips(spark, sf), gold.TRIPS_YMDH)
    landed = feeds.landing_rows(stamp(trips, feeds.PROCESS_TS), "trips_hourly")
    assert landed.schema.names == contracts.LANDING["trips_hourly"].names
    assert landed.filter("HORA is null or ANO is null or GOLD_PROCESS_TS is null").count() == 0
    jams = stamp(v.gold_traffic(spark, sf), feeds.PROCESS_TS)
    landed = feeds.landing_traffic(jams, v.gold_gps(spark, sf))
    assert landed.count() == jams.count()
    assert landed.filter("VELOCIDADE_MEDIA is not null and GOLD_PROCESS_TS is not null").count() > 0


def test_silver_with_a_horizon(spark, sf, folder):
    lake, source = Lake(folder + "/lake"), folder + "/records"
    records = v.RECORDS["trips"](spark, sf).filter("timestamp < timestamp '2024-01-03'")
    deliver(records, source)
    deliver(records, source)
    stream = lake_stream(spark, source, contracts.RECORD)
    feeds.start_bronze(stream, lake, "trips", NOW).awaitTermination()
    feeds.start_silver(
        spark, lake, "trips", NOW, horizon="7 days"
    ).awaitTermination()
    silver = lake_read(spark, lake.table("silver", "trips"))
    assert silver.count() == feeds.silver_batch(spark, lake, "trips").count()


# --- refresh -------------------------------------------------------------------------------------


def deliver_by_day(df, path):
    df.coalesce(1).write.mode("append").partitionBy("event_date").parquet(path)


def start_refresh(spark, schema, path, target, checkpoint, **more):
    query = refresh_touched(
        lake_stream(spark, path, schema, max_files=10),
        gold.TRIPS_HOURLY, path, target, checkpoint,
        grain=("event_date",), partition_by=("event_date",), schema=schema, trigger=NOW, **more,
    )
    query.awaitTermination()


def test_refresh_survives_increments_resume_and_replay(spark, sf, folder):
    path, target = folder + "/silver", folder + "/gold"
    trips = v.trips(spark, sf).filter("event_date < date '2024-01-11'")
    for part in range(3):
        deliver_by_day(trips.filter(f"trip_id % 3 = {part}"), path)
        start_refresh(spark, trips.schema, path, target, folder + "/ck")
        so_far = trips.filter(f"trip_id % 3 <= {part}")
        assert same_rows(rollup(so_far, gold.TRIPS_HOURLY), lake_read(spark, target))
    start_refresh(spark, trips.schema, path, target, folder + "/ck")
    start_refresh(spark, trips.schema, path, target, folder + "/other-ck")
    assert same_rows(rollup(trips, gold.TRIPS_HOURLY), lake_read(spark, target))


def test_refresh_with_dedup(spark, sf, folder):
    path, target = folder + "/silver", folder + "/gold"
    trips = v.trips(spark, sf)
    deliver_by_day(trips, path)
    deliver_by_day(trips, path)
    start_refresh(
        spark, trips.schema, path, target, folder + "/ck", dedup_keys=("trip_id", "event_ts")
    )
    once = dedup_events(trips, ("trip_id", "event_ts"))
    assert same_rows(rollup(once, gold.TRIPS_HOURLY), lake_read(spark, target))


def test_only_touched_prunes_the_scan(spark, sf, folder):
    path = folder + "/silver"
    trips = v.trips(spark, sf)
    trips.coalesce(1).write.partitionBy("event_date", "event_hour").parquet(path)
    batch = trips.filter("event_date = date '2024-01-02' and event_hour in (3, 4)")
    hours = ("event_date", "event_hour")
    touched = only_touched(spark, path, batch, hours, trips.schema)
    assert same_rows(touched, batch)
    # Two of some 720 folders are listed, however many there are.
    assert len(touched.inputFiles()) == 2
    assert only_touched(spark, path, batch.limit(0), hours, trips.schema) is None
    nowhere = batch.withColumn("event_hour", F.lit(99))
    assert only_touched(spark, path, nowhere, hours, trips.schema) is None
    timed = only_touched(spark, path, batch, hours, trips.schema, time_column="event_ts")
    assert same_rows(timed, batch)
    plan = timed._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(event_ts," in plan


def test_a_grain_finer_than_the_partitions(spark, sf, folder):
    path = folder + "/silver"
    trips = v.trips(spark, sf)
    deliver_by_day(trips, path)
    batch = trips.filter("event_date = date '2024-01-02' and event_hour in (3, 4)")
    touched = only_touched(
        spark, path, batch, ("event_date",), trips.schema, ("event_date", "event_hour")
    )
    assert same_rows(touched, batch)


def test_partitions_that_hold_more_than_a_group_are_refused(spark):
    hour = ("event_date", "event_hour")
    for partitions in (hour, ("year", "month", "day", "hour")):
        check_grain(hour, partitions)
        check_grain(("year", "month", "day", "hour"), partitions)
    check_grain(("event_date",), hour)
    with pytest.raises(ValueError, match="must be a partition column"):
        check_grain(hour, ("event_date",))
    with pytest.raises(ValueError, match="partition column 'city'"):
        folder_name("city", "Rio")


def test_empty_batch_writes_nothing(spark, sf, folder):
    path, target = folder + "/silver", folder + "/gold"
    trips = v.trips(spark, sf)
    deliver(trips.limit(0), path)
    deliver(trips.withColumn("event_date", F.lit(None).cast("date")), path)
    start_refresh(spark, trips.schema, path, target, folder + "/ck")
    assert not os.path.exists(target)


# --- partials ------------------------------------------------------------------------------------

PARTIAL = RollupSpec(
    "p", ("event_date", "status"), (rows("n"), mean("m", "price"), total("t", "price"))
)


def run_partials(spark, schema, path, target, checkpoint):
    stream = lake_stream(spark, path, schema, max_files=1)
    append_partials(stream, PARTIAL, target, checkpoint, trigger=NOW).awaitTermination()


def test_partials_merge_resume_and_retry(spark, sf, folder):
    path, target, checkpoint = (f"{folder}/{n}" for n in ("in", "out", "ck"))
    trips = v.trips(spark, sf)
    deliver(trips.filter("trip_id % 2 = 0"), path)
    run_partials(spark, trips.schema, path, target, checkpoint)
    deliver(trips.filter("trip_id % 2 = 1"), path)
    run_partials(spark, trips.schema, path, target, checkpoint)
    full = rollup(trips, PARTIAL)
    assert same_rows(full, merge_partials(spark, PARTIAL, target))
    # The last batch is retried when its commit entry is missing.
    last = max(glob.glob(checkpoint + "/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    os.remove(last)
    crc = os.path.join(os.path.dirname(last), f".{os.path.basename(last)}.crc")
    if os.path.exists(crc):
        os.remove(crc)
    run_partials(spark, trips.schema, path, target, checkpoint)
    assert same_rows(full, merge_partials(spark, PARTIAL, target))
    with pytest.raises(ValueError, match="another checkpoint"):
        run_partials(spark, trips.schema, path, target, folder + "/new-ck")


# --- dedup and late rows ---------------------------------------------------------------------------

EVENT = "id string, event_ts timestamp, n int"


def events(spark, *rows_in):
    return spark.createDataFrame([(i, at(t), n) for i, t, n in rows_in], EVENT)


def in_order(spark, folder, *files):
    path = folder + "/in"
    for rows_in in files:
        deliver(events(spark, *rows_in), path)
    return lake_stream(spark, path, _schema(spark), max_files=1)


def _schema(spark):
    return spark.createDataFrame([], EVENT).schema


def test_stream_dedup_within_horizon_and_late_rows(spark, folder):
    stream = in_order(
        spark, folder,
        [("a", "2024-01-01 00:00:00", 1), ("a", "2024-01-01 00:10:00", 2)],
        [("a", "2024-01-01 00:20:00", 3), ("b", "2024-01-01 09:00:00", 4)],
        [("c", "2024-01-01 09:30:00", 5)],
        [("d", "2024-01-01 01:00:00", 6), ("a", "2024-01-01 09:40:00", 7)],
    )
    kept = dedup_events(stream, ("id",), horizon="1 hour")
    lake_append_stream(kept, folder + "/out", folder + "/ck", trigger=NOW).awaitTermination()
    found = sorted((r["id"], r["n"]) for r in lake_read(spark, folder + "/out").collect())
    # d is late; a is new again once its horizon has passed.
    assert [i for i, _ in found] == ["a", "a", "b", "c"]
    assert ("a", 7) in found and ("a", 3) not in found


def test_append_new_is_exact_for_late_repeats(spark, folder):
    path, target, checkpoint = (f"{folder}/{n}" for n in ("in", "out", "ck"))

    def run(*rows_in):
        deliver(events(spark, *rows_in).withColumn("event_date", F.to_date("event_ts")), path)
        schema = spark.read.parquet(path).schema
        append_new(
            lake_stream(spark, path, schema, max_files=1), ("id", "event_ts"), target, checkpoint,
            ("event_date",), order=("n",), trigger=NOW,
        ).awaitTermination()
        return sorted((r["id"], r["n"]) for r in lake_read(spark, target).collect())

    assert run(("a", "2024-01-01 00:00:00", 2), ("a", "2024-01-01 00:00:00", 1)) == [("a", 1)]
    assert run(("b", "2024-03-01 00:00:00", 1)) == [("a", 1), ("b", 1)]
    again = run(("a", "2024-01-01 00:00:00", 9), ("a", "2024-01-01 00:00:01", 3))
    assert again == [("a", 1), ("a", 3), ("b", 1)]
    # The last batch is retried: nothing is added twice.
    last = max(glob.glob(checkpoint + "/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    os.remove(last)
    os.remove(os.path.join(os.path.dirname(last), f".{os.path.basename(last)}.crc"))
    assert run(("c", "2024-01-01 00:00:00", 1)) == sorted([*again, ("c", 1)])


def test_append_new_across_partitions(spark, folder):
    """The key does not hold the event time, so a repeat may carry another day."""
    path, target, checkpoint = (f"{folder}/{n}" for n in ("in", "out", "ck"))
    for day in ("2024-01-01 00:00:00", "2024-02-01 00:00:00"):
        deliver(events(spark, ("a", day, 1)).withColumn("event_date", F.to_date("event_ts")), path)
        append_new(
            lake_stream(spark, path, spark.read.parquet(path).schema), ("id",), target, checkpoint,
            ("event_date",), index=folder + "/index", trigger=NOW,
        ).awaitTermination()
    assert lake_read(spark, target).count() == 1
    # A retried batch adds nothing, also when only its index rows are missing.
    last = max(glob.glob(checkpoint + "/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    os.remove(last)
    os.remove(os.path.join(os.path.dirname(last), f".{os.path.basename(last)}.crc"))
    deliver(events(spark, ("b", "2024-02-01 00:00:00", 1)).withColumn("event_date", F.to_date("event_ts")), path)
    append_new(
        lake_stream(spark, path, spark.read.parquet(path).schema), ("id",), target, checkpoint,
        ("event_date",), index=folder + "/index", trigger=NOW,
    ).awaitTermination()
    assert sorted(r["id"] for r in lake_read(spark, target).collect()) == ["a", "b"]
    assert [(run.batch, run.notes["keys"]) for run in runs.live(spark, folder + "/index")] == [(0, 1), (2, 1)]


@pytest.mark.parametrize("feed", list(feeds.FEEDS))
def test_stream_rebuild_stream_equals_batch(spark, sf, folder, feed):
    lake, source = Lake(folder + "/lake"), folder + "/records"
    times = "timestamp between timestamp '2024-01-01 14:00' and timestamp '2024-01-01 23:00'"
    records = v.RECORDS[feed](spark, sf).filter(times)

    def step(part):
        deliver(records.filter(part), source)
        stream = lake_stream(spark, source, contracts.RECORD)
        feeds.start_bronze(stream, lake, feed, NOW).awaitTermination()
        feeds.start_silver(spark, lake, feed, NOW, rejects=True).awaitTermination()

    step("offset % 3 = 0")
    feeds.rebuild_silver(spark, lake, feed)
    step("offset % 3 = 1")
    step("offset % 3 = 0")
    feeds.rebuild_silver(spark, lake, feed)
    step("offset % 3 = 2")
    silver = lake_read(spark, lake.table("silver", feed), contracts.SILVER[feed])
    batch = feeds.silver_batch(spark, lake, feed)
    keys = feeds.FEEDS[feed].dedup_keys
    if keys:
        assert same_rows(silver.select(*keys), batch.select(*keys))
    else:
        assert same_rows(drop_stamps(silver), drop_stamps(batch))
    marked = MARK[feed](lake_read(spark, lake.table("bronze", feed), contracts.BRONZE[feed]))
    assert lake_read(spark, lake.table("rejects", feed)).count() == rejected(marked).count()


def test_repeats_on_other_hours_and_gold_from_stream_and_rebuild(spark, sf, folder):
    """One event id at two hours is one row, and gold counts it once whichever way it is made."""
    lake, source = Lake(folder + "/lake"), folder + "/records"
    records = v.RECORDS["traffic"](spark, sf).filter("timestamp < timestamp '2024-01-01 08:00'")
    later = F.regexp_replace(F.col("value").cast("string"), "2024-01-01", "2024-01-03")
    for rows_in in (records, records.withColumn("value", later.cast("binary"))):
        deliver(rows_in, source)
        run_feed(spark, lake, "traffic", source)
    silver = lake_read(spark, lake.table("silver", "traffic"))
    assert silver.count() == silver.select("event_id").distinct().count()
    assert silver.count() == feeds.silver_batch(spark, lake, "traffic").count()
    spec = gold.TRAFFIC_HOURLY
    streamed = lake_read(spark, lake.table("gold", spec.name)).persist()
    streamed.count()
    silver.limit(3).write.mode("append").partitionBy(*feeds.FEEDS["traffic"].silver_partitions).parquet(
        lake.table("silver", "traffic")
    )
    feeds.start_landing(spark, lake, "traffic", spec, NOW).awaitTermination()
    feeds.rebuild_gold(spark, lake, "traffic", spec)
    rebuilt = lake_read(spark, lake.table("gold", spec.name))
    assert same_rows(drop_stamps(streamed), drop_stamps(rebuilt))


def test_landing_follows_a_second_refresh_of_an_hour(spark, sf, folder):
    lake, source = Lake(folder + "/lake"), folder + "/records"
    records = v.RECORDS["trips"](spark, sf).filter("timestamp < timestamp '2024-01-01 03:00'")
    for part in range(2):
        deliver(records.filter(f"offset % 2 = {part}"), source)
        run_feed(spark, lake, "trips", source)
        feeds.start_landing(spark, lake, "trips", gold.TRIPS_YMDH, NOW).awaitTermination()
    stored = lake_read(spark, lake.table("gold", gold.TRIPS_YMDH.name)).drop("gold_process_ts")
    landed = lake_read(spark, lake.table("landing", gold.TRIPS_YMDH.name))
    wanted = feeds.landing_rows(stored, gold.TRIPS_HOURLY.name)
    names = [n for n in wanted.columns if n != "GOLD_PROCESS_TS"]
    assert same_rows(wanted.select(*names), landed.select(*names))


def test_partials_without_a_column_and_compaction(spark, sf, folder):
    path, target, checkpoint = (f"{folder}/{n}" for n in ("in", "out", "ck"))
    trips = v.trips(spark, sf).drop("price", "driver_id")
    spec = RollupSpec(
        "p", ("event_date", "status"),
        (rows("n"), mean("m", "price", optional=True), total("t", "price", optional=True),
         low("first", "event_ts", optional=True), low("none", "missing", optional=True, dtype="int"),
         approx("drivers", "driver_id", optional=True)),
    )

    def add(part):
        deliver(trips.filter(f"trip_id % 3 = {part}"), path)
        stream = lake_stream(spark, path, trips.schema, max_files=1)
        append_partials(stream, spec, target, checkpoint, trigger=NOW).awaitTermination()

    def check(parts):
        merged = merge_partials(spark, spec, target)
        full = rollup(trips.filter(f"trip_id % 3 < {parts}"), spec)
        assert merged.schema == full.schema or merged.dtypes == full.dtypes
        assert same_rows(full, merged)

    add(0)
    add(1)
    check(2)
    assert compact_partials(spark, spec, target, fan=2) == 1
    check(2)
    add(2)
    check(3)
    for _ in range(2):
        compact_partials(spark, spec, target, fan=2)
        check(3)


HOURLY = RollupSpec("h", ("event_date", "event_hour"), (rows("n"), total("t", "n")))


def test_hourly_windows_close_once_and_drop_late_rows(spark, folder):
    stream = in_order(
        spark, folder,
        [("a", "2024-01-01 00:10:00", 1), ("b", "2024-01-01 00:50:00", 2)],
        [("c", "2024-01-01 05:00:00", 4)],
        [("d", "2024-01-01 05:10:00", 8)],
        [("late", "2024-01-01 00:30:00", 16)],
        [("sentinel", "2024-01-01 09:00:00", 32)],
    )
    hourly = hourly_stream(stream, HOURLY, "1 hour")
    assert hourly.columns == HOURLY.columns
    lake_append_stream(hourly, folder + "/out", folder + "/ck", trigger=NOW).awaitTermination()
    found = sorted(tuple(r) for r in lake_read(spark, folder + "/out").drop("event_date").collect())
    assert found == [(0, 2, 3.0), (5, 2, 12.0)]


def test_hours_close_once_and_late_rows_are_counted_and_put_right(spark, folder):
    path, target, checkpoint = (f"{folder}/{n}" for n in ("in", "out", "ck"))
    every = []

    def run(*rows_in):
        every.extend(rows_in)
        new = events(spark, *rows_in).withColumn("event_date", F.to_date("event_ts")).withColumn("event_hour", F.hour("event_ts"))
        new.coalesce(1).write.mode("append").partitionBy("event_date", "event_hour").parquet(path)
        schema = T.StructType([*_schema(spark), T.StructField("event_date", T.DateType()), T.StructField("event_hour", T.IntegerType())])
        start_closed_hours(
            lake_stream(spark, path, schema), HOURLY, path, target, checkpoint, schema=schema, trigger=NOW
        ).awaitTermination()
        if not os.path.exists(target):
            return [], late_rows(spark, checkpoint)
        return sorted((r["event_hour"], r["n"], r["t"]) for r in lake_read(spark, target).collect()), late_rows(spark, checkpoint)

    assert run(("a", "2024-01-01 00:10:00", 1), ("b", "2024-01-01 00:50:00", 2)) == ([], 0)
    assert run(("c", "2024-01-01 05:00:00", 4)) == ([(0, 2, 3.0)], 0)
    # On time for its own hour, and late for another one.
    assert run(("d", "2024-01-01 05:10:00", 8), ("late", "2024-01-01 00:30:00", 16)) == ([(0, 3, 19.0)], 1)
    assert run(("e", "2024-01-01 04:10:00", 32)) == ([(0, 3, 19.0)], 1)  # not over yet
    wanted = [(0, 3, 19.0), (4, 1, 32.0), (5, 2, 12.0)]
    assert run(("sentinel", "2024-01-01 09:00:00", 64)) == (wanted, 1)
    # A retried batch counts nothing twice.
    last = max(glob.glob(checkpoint + "/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    os.remove(last)
    os.remove(os.path.join(os.path.dirname(last), f".{os.path.basename(last)}.crc"))
    assert run(("later", "2024-01-01 00:31:00", 128)) == ([(0, 4, 147.0), *wanted[1:]], 2)


def test_stream_static_region_join(spark, sf, folder):
    path = folder + "/in"
    seen = v.traffic(spark, sf).select("event_id", "region_id")
    deliver(seen, path)
    regions = spark.createDataFrame([("X", "r1", "L", 1.0, 2.0)], contracts.REGIONS)
    joined = with_region(lake_stream(spark, path, seen.schema), regions)
    lake_append_stream(joined, folder + "/out", folder + "/ck", trigger=NOW).awaitTermination()
    assert same_rows(with_region(seen, regions), lake_read(spark, folder + "/out"))


def test_timed_trigger_and_names(spark, folder):
    deliver(events(spark, ("a", "2024-01-01 00:00:00", 1)), folder + "/in")
    stream = lake_stream(spark, folder + "/in", _schema(spark))
    query = lake_append_stream(
        stream, folder + "/out", folder + "/ck", trigger={"processingTime": "1 seconds"}, name="timed"
    )
    try:
        query.processAllAvailable()
        assert query.name == "timed" and query.isActive
    finally:
        query.stop()
    assert lake_read(spark, folder + "/out").count() == 1
