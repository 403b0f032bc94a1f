"""Queries that write tables or run streams and read the result back."""

from __future__ import annotations


from pyspark.sql import functions as F

from entry_queries import views as v
from entry_queries.registry import query
from entry_queries.views import with_views
from mobility_lake import contracts
from mobility_lake.catalog import Lake
from mobility_lake.operators.layout import one_file_each
from mobility_lake.operators.rollup import rollup
from mobility_lake.plans import gold
from mobility_lake.plans.feeds import (
    landing_rows,
    landing_traffic,
    rebuild_silver,
    start_silver,
)
from mobility_lake.session import shared_dir
from mobility_lake.sources.landing import load_by_name
from mobility_lake.sources.lake import (
    file_inventory,
    lake_append_stream,
    lake_read,
    lake_rebuild,
    lake_stream,
)
from mobility_lake.streaming.late import start_closed_hours
from mobility_lake.streaming.incremental import (
    append_new,
    append_partials,
    compact_partials,
    hourly_stream,
    merge_partials,
    refresh_touched,
)

NOW = {"availableNow": True}


@query(
    "scan_partition_prune",
    with_views(
        "select * from trips where event_date = (select max(event_date) from trips)", "trips"
    ),
)
def scan_partition_prune(spark, sf):
    """Trips written by day; the last day is read back from its partition alone."""
    path = shared_dir(spark, "trips")
    lake_rebuild(v.trips(spark, sf), path, ("event_date",))
    stored = lake_read(spark, path)
    last = stored.agg(F.max("event_date")).first()[0]
    return stored.filter(F.col("event_date") == F.lit(last))


@query("rebuild_roundtrip", with_views("select * from gold_trips", "gold_trips"))
def rebuild_roundtrip(spark, sf):
    """A rollup written twice over the same path and read back."""
    path = shared_dir(spark, "gold")
    rolled = v.gold_trips(spark, sf)
    for _ in range(2):
        lake_rebuild(rolled, path, ("event_date",), one_file_each)
    return lake_read(spark, path)


@query(
    "load_by_name",
    with_views(
        f"""select status as "STATUS", source as "FONTE", count(*) as "QTD_REGISTROS",
        count(distinct trip_id) as "QTD_VIAGENS_DISTINTAS",
        count(distinct passenger_id) as "QTD_PASSAGEIROS_DISTINTOS",
        count(distinct driver_id) as "QTD_MOTORISTAS_DISTINTOS",
        {v.mean('price')} as "PRECO_MEDIO", {v.total('price')} as "PRECO_TOTAL",
        cast(null as timestamp) as "GOLD_PROCESS_TS", cast(hour as bigint) as "HORA",
        cast(year as bigint) as "ANO", cast(month as bigint) as "MES",
        cast(day as bigint) as "DIA"
        from trips group by status, source, year, month, day, hour""",
        "trips",
    ),
)
def load(spark, sf):
    """The hourly rollup, in wire spelling and with an extra column, into the landing table."""
    rolled = rollup(v.trips(spark, sf), gold.TRIPS_YMDH).withColumn("extra", F.lit(1))
    wire = contracts.to_wire(rolled, "gold.trips_hourly")
    return load_by_name(wire, contracts.LANDING["trips_hourly"])


@query(
    "file_inventory",
    with_views(
        """select event_date, count(*) as records, true as has_files, true as has_bytes
        from trips group by event_date""",
        "trips",
    ),
)
def inventory(spark, sf):
    """File counts and sizes depend on the cluster, so the comparison has them as flags."""
    path = shared_dir(spark, "trips")
    lake_rebuild(v.trips(spark, sf), path, ("event_date",))
    found = file_inventory(lake_read(spark, path), ("event_date",))
    return found.select(
        "event_date",
        "records",
        (F.col("files") > 0).alias("has_files"),
        (F.col("bytes") > 0).alias("has_bytes"),
    )


@query("refresh_touched", with_views("select * from gold_trips", "gold_trips"))
def refresh(spark, sf):
    """Hourly trips kept exact while a table by day is streamed in six steps."""
    trips = v.trips(spark, sf)
    files = v.as_files(spark, trips, "event_ts", ("event_date",))
    target, checkpoint = shared_dir(spark, "gold"), shared_dir(spark, "checkpoint")
    schema = trips.schema
    refresh_touched(
        lake_stream(spark, files.path, schema, files.max_files),
        gold.TRIPS_HOURLY,
        files.path,
        target,
        checkpoint,
        schema=schema,
        silver_partitions=("event_date",),
        trigger=NOW,
    ).awaitTermination()
    return lake_read(spark, target)


_COUNTS = {
    "distinct_trips": "trip_id",
    "distinct_passengers": "passenger_id",
    "distinct_drivers": "driver_id",
}
_BOUNDED = ", ".join(f"true as {name}_within_bound" for name in _COUNTS)


def _bounded(estimated, exact):
    """Estimates next to the exact counts: within 10 %, or one of the smallest groups."""
    keys = list(gold.TRIPS_HOURLY.keys)
    counts = exact.select(*keys, *[F.col(name).alias(f"_{name}") for name in _COUNTS])
    joined = estimated.join(counts, keys)
    for name in _COUNTS:
        near = F.abs(F.col(name) - F.col(f"_{name}")) <= 0.1 * F.col(f"_{name}") + 1
        joined = joined.withColumn(f"{name}_within_bound", near)
        joined = joined.withColumn(name, F.col(f"_{name}")).drop(f"_{name}")
    return joined


@query("partials_merge", with_views("select * from gold_trips", "gold_trips"))
def partials(spark, sf):
    """Mergeable partial rows of six micro-batches, compacted; distinct counts are exact."""
    trips = v.trips(spark, sf)
    files = v.as_files(spark, trips, "event_ts")
    target = shared_dir(spark, "partials")
    append_partials(
        lake_stream(spark, files.path, trips.schema, files.max_files),
        gold.TRIPS_HOURLY,
        target,
        shared_dir(spark, "checkpoint"),
        trigger=NOW,
    ).awaitTermination()
    compact_partials(spark, gold.TRIPS_HOURLY, target, fan=4)
    return merge_partials(spark, gold.TRIPS_HOURLY, target)


@query(
    "window_hourly",
    with_views(
        f"""select *, {_BOUNDED}
        from gold_trips where event_date + (event_hour + 1) * interval 1 hour
            <= (select max(event_ts) - interval 1 hour from trips)""",
        "gold_trips",
    ),
)
def windows(spark, sf):
    """Hours the watermark has closed, over six micro-batches in the order of time."""
    trips = v.trips(spark, sf)
    files = v.as_ordered_files(spark, trips, "event_ts")
    target, checkpoint = shared_dir(spark, "windows"), shared_dir(spark, "checkpoint")
    stream = lake_stream(spark, files.path, trips.schema, files.max_files)
    hourly = hourly_stream(stream, gold.TRIPS_HOURLY, "1 hour")
    lake_append_stream(hourly, target, checkpoint, ("event_date",), NOW).awaitTermination()
    return _bounded(lake_read(spark, target, hourly.schema), v.gold_trips(spark, sf))


@query(
    "closed_hours_late",
    with_views(
        """select * from gold_trips where event_date + (event_hour + 1) * interval 1 hour
            <= (select max(event_ts) - interval 1 hour from trips)""",
        "gold_trips",
    ),
)
def closed_hours(spark, sf):
    """Hours that are over, from six micro-batches out of the order of time: late rows are in, counts are exact."""
    trips = v.trips(spark, sf)
    files = v.as_files(spark, trips, "trip_id", ("event_date",))
    target, checkpoint = shared_dir(spark, "closed"), shared_dir(spark, "checkpoint")
    start_closed_hours(
        lake_stream(spark, files.path, trips.schema, files.max_files),
        gold.TRIPS_HOURLY,
        files.path,
        target,
        checkpoint,
        schema=trips.schema,
        silver_partitions=("event_date",),
        trigger=NOW,
    ).awaitTermination()
    return lake_read(spark, target)


_SURVIVORS = """select trip_id, event_id, event_ts, ingest_ts, "offset", value from duplicated
    qualify row_number() over (partition by {keys} order by ingest_ts, "offset") = 1"""


def _dedup(spark, rows, keys, **more):
    """`rows` through `append_new` in the order they were ingested."""
    rows = rows.withColumn("event_date", F.to_date("event_ts"))
    files = v.as_ordered_files(spark, rows, "ingest_ts")
    target = shared_dir(spark, "silver")
    append_new(
        lake_stream(spark, files.path, rows.schema, files.max_files),
        keys,
        target,
        shared_dir(spark, "checkpoint"),
        ("event_date",),
        order=("ingest_ts", "offset"),
        trigger=NOW,
        **more,
    ).awaitTermination()
    return lake_read(spark, target, rows.schema).drop("event_date")


@query("dedup_stream", with_views(_SURVIVORS.format(keys="event_id, event_ts"), "duplicated"))
def dedup_stream(spark, sf):
    """The first row per key over six micro-batches, deduplicated against the table itself."""
    return _dedup(spark, v.duplicated(spark, sf), ("event_id", "event_ts"), time_column="event_ts")


@query(
    "dedup_stream_id",
    with_views(
        """select trip_id, event_id, event_ts, ingest_ts, "offset", value from (
            select * from duplicated union all
            select trip_id, event_id, event_ts + interval 40 day, ingest_ts + interval 40 day,
                "offset", value from duplicated where event_id % 3 = 0)
        qualify row_number() over (partition by event_id order by ingest_ts, "offset") = 1""",
        "duplicated",
    ),
)
def dedup_stream_id(spark, sf):
    """The first row per id; a third of the events come again with the time of another day."""
    once = v.duplicated(spark, sf)
    later = {name: F.col(name) + F.expr("interval 40 day") for name in ("event_ts", "ingest_ts")}
    rows = once.unionByName(once.filter("event_id % 3 = 0").withColumns(later))
    return _dedup(spark, rows, ("event_id",), index=shared_dir(spark, "index"))


@query(
    "rebuild_then_stream",
    with_views(
        """select vehicle_id, city, state, event_ts, speed_kmh, precision_m from gps
        where vehicle_id is not null or city is not null""",
        "gps",
    ),
)
def rebuild_then_stream(spark, sf):
    """GPS silver: half streamed, rebuilt from bronze, the other half streamed behind it."""
    lake = Lake(shared_dir(spark, "lake"))
    wanted = {"vehicle_id": "string", "precision_m": "int"}
    rows = v.gps(spark, sf).withColumns({c: F.col(c).cast(t) for c, t in wanted.items()})
    names = {f.name for f in contracts.BRONZE["gps"]} & set(rows.columns)
    bronze = lake.table("bronze", "gps")
    for half in (0, 1):
        part = rows.filter(F.pmod(F.xxhash64("event_ts", "vehicle_id"), F.lit(2)) == half)
        part.select(*names).write.mode("append").partitionBy("event_date").parquet(bronze)
        start_silver(spark, lake, "gps", NOW, max_files=None).awaitTermination()
        if half == 0:
            rebuild_silver(spark, lake, "gps")
    stored = lake_read(spark, lake.table("silver", "gps"), contracts.SILVER["gps"])
    return stored.select(
        F.col("vehicle_id").cast("bigint").alias("vehicle_id"),
        "city",
        "state",
        "event_ts",
        "speed_kmh",
        "precision_m",
    )


_NO_STAMP = 'cast(null as varchar) as "FONTE", cast(null as timestamp) as "GOLD_PROCESS_TS"'


@query(
    "load_gps",
    with_views(
        f"""select city as "CIDADE", cast(null as double) as "LATITUDE",
        cast(null as double) as "LONGITUDE", mean_speed as "VELOCIDADE_MEDIA", {_NO_STAMP}
        from gold_gps""",
        "gold_gps",
    ),
)
def load_gps(spark, sf):
    """Hourly GPS as its landing table."""
    return landing_rows(v.gold_gps(spark, sf), "gps_hourly")


@query(
    "load_weather",
    with_views(
        f"""select city as "CIDADE", mean_temperature as "TEMPERATURA_MEDIA",
        total_rain as "CHUVA_MM", condition as "CONDICAO", {_NO_STAMP} from gold_weather""",
        "gold_weather",
    ),
)
def load_weather(spark, sf):
    """Hourly weather as its landing table."""
    return landing_rows(v.gold_weather(spark, sf), "weather_hourly")


@query(
    "load_incidents",
    with_views(
        f"""select city as "CIDADE", type as "TIPO_INCIDENTE", incidents as "QUANTIDADE",
        {_NO_STAMP} from gold_incidents""",
        "gold_incidents",
    ),
)
def load_incidents(spark, sf):
    """Hourly incidents as their landing table."""
    return landing_rows(v.gold_incidents(spark, sf), "incidents_hourly")


@query(
    "load_traffic",
    with_views(
        f"""select city as "CIDADE", congestion_level as "NIVEL_CONGESTIONAMENTO",
        mean_speed as "VELOCIDADE_MEDIA", {_NO_STAMP} from staged_traffic""",
        "staged_traffic",
    ),
)
def load_traffic(spark, sf):
    """Hourly traffic as its landing table, with the mean speed of the city's hour."""
    return landing_traffic(v.gold_traffic(spark, sf), v.gold_gps(spark, sf))
