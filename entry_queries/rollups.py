"""Rollups, aggregates and deduplication."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from entry_queries import views as v
from entry_queries.registry import query
from entry_queries.views import with_views
from mobility_lake import contracts
from mobility_lake.operators.conform import pick_spellings
from mobility_lake.operators.dedup import dedup_events
from mobility_lake.operators.rollup import (
    RollupSpec,
    approx,
    count_if,
    distinct,
    mean,
    rollup,
    rollup_merge,
    rollup_partial,
    rows,
    total,
)
from mobility_lake.plans import gold


@query("rollup_trips_hourly", with_views("select * from gold_trips", "gold_trips"))
def rollup_trips_hourly(spark, sf):
    return v.gold_trips(spark, sf)


@query(
    "rollup_trips_ymdh",
    with_views(
        f"""select status, source, year, month, day, hour, count(*) as records,
        count(distinct trip_id) as distinct_trips,
        count(distinct passenger_id) as distinct_passengers,
        count(distinct driver_id) as distinct_drivers,
        {v.mean('price')} as mean_price, {v.total('price')} as total_price
        from trips group by status, source, year, month, day, hour""",
        "trips",
    ),
)
def rollup_trips_ymdh(spark, sf):
    return rollup(v.trips(spark, sf), gold.TRIPS_YMDH)


@query(
    "rollup_trips_aliases",
    with_views(
        """select event_date, event_hour, status, 'desconhecida' as source, count(*) as records,
        count(distinct trip_id) as distinct_trips,
        count(distinct passenger_id) as distinct_passengers,
        cast(null as bigint) as distinct_drivers,
        cast(null as double) as mean_price, cast(null as double) as total_price
        from trips group by event_date, event_hour, status""",
        "trips",
    ),
)
def rollup_trips_aliases(spark, sf):
    """Renamed ids; no driver, price or source column at all."""
    renamed = v.trips(spark, sf).select(
        "event_date",
        "event_hour",
        "status",
        F.col("trip_id").alias("viagem_id"),
        F.col("passenger_id").alias("id_passageiro"),
    )
    return rollup(pick_spellings(renamed, contracts.TRIP_COLUMN_NAMES), gold.TRIPS_HOURLY)


@query("rollup_gps_hourly", with_views("select * from gold_gps", "gold_gps"))
def rollup_gps_hourly(spark, sf):
    return v.gold_gps(spark, sf)


_MOBILITY = f"""select event_date, event_hour, state, city, neighbourhood, vehicle_type,
    count(*) as signals, {{distinct}} {v.mean('speed_kmh')} as mean_speed,
    max(speed_kmh) as max_speed, min(speed_kmh) as min_speed,
    {v.mean('precision_m')} as mean_precision from gps
    where vehicle_id is not null and speed_kmh is not null
    group by event_date, event_hour, state, city, neighbourhood, vehicle_type"""


def _bounded(df, spec, name, column):
    """The rollup with its estimate `name` replaced by the exact count and whether they agree.

    Within three standard errors of 5 %, and one more for the smallest groups.
    """
    both = replace(spec, measures=(*spec.measures, distinct("_exact", column)))
    near = F.abs(F.col(name) - F.col("_exact")) <= 0.15 * F.col("_exact") + 1
    rolled = rollup(df, both).withColumn("within_bound", near)
    return rolled.withColumn(name, F.col("_exact")).drop("_exact")


@query(
    "rollup_gps_mobility",
    with_views(
        _MOBILITY.format(
            distinct="count(distinct vehicle_id) as distinct_vehicles, true as within_bound,"
        ),
        "gps",
    ),
)
def rollup_gps_mobility(spark, sf):
    """As coded, with an approximate vehicle count that is held against the exact one."""
    return _bounded(v.gps(spark, sf), gold.GPS_MOBILITY_HOURLY, "distinct_vehicles", "vehicle_id")


@query(
    "rollup_gps_mobility_exact",
    with_views(
        _MOBILITY.format(distinct="count(distinct vehicle_id) as distinct_vehicles,"), "gps"
    ),
)
def rollup_gps_mobility_exact(spark, sf):
    return rollup(v.gps(spark, sf), gold.GPS_MOBILITY_HOURLY.exact())


@query("rollup_weather_hourly", with_views("select * from gold_weather", "gold_weather"))
def rollup_weather_hourly(spark, sf):
    return v.gold_weather(spark, sf)


_CONDITION = """select event_date, event_hour, state, city, condition,
    count(*) as observations {distinct} from weather
    group by event_date, event_hour, state, city, condition"""


@query(
    "rollup_weather_condition",
    with_views(
        _CONDITION.format(
            distinct=", count(distinct source) as distinct_sources, true as within_bound"
        ),
        "weather",
    ),
)
def rollup_weather_condition(spark, sf):
    """As coded, with an approximate source count that is held against the exact one."""
    weather = v.weather(spark, sf)
    return _bounded(weather, gold.WEATHER_CONDITION_HOURLY, "distinct_sources", "source")


@query(
    "rollup_weather_condition_exact",
    with_views(
        _CONDITION.format(distinct=", count(distinct source) as distinct_sources"), "weather"
    ),
)
def rollup_weather_condition_exact(spark, sf):
    return rollup(v.weather(spark, sf), gold.WEATHER_CONDITION_HOURLY.exact())


@query("rollup_traffic_hourly", with_views("select * from gold_traffic", "gold_traffic"))
def rollup_traffic_hourly(spark, sf):
    return v.gold_traffic(spark, sf)


@query("rollup_incidents_hourly", with_views("select * from gold_incidents", "gold_incidents"))
def rollup_incidents_hourly(spark, sf):
    return v.gold_incidents(spark, sf)


@query(
    "rollup_incidents_detail",
    with_views(
        """select event_date, event_hour, state, city, neighbourhood, type, severity, impact,
        count(*) as incidents, count(distinct incident_id) as distinct_incidents,
        count(*) filter (where lane_closed) as lane_closed, max(event_ts) as latest_event_ts
        from incidents where city is not null and type is not null
        group by event_date, event_hour, state, city, neighbourhood, type, severity, impact""",
        "incidents",
    ),
)
def rollup_incidents_detail(spark, sf):
    return rollup(v.incidents(spark, sf), gold.INCIDENTS_DETAIL_HOURLY)


@query(
    "agg_distinct_exact",
    """select event_type, count(distinct user_id) as users,
    count(distinct cast(json_extract_string(props, '$.k') as integer)) as ks
    from events group by event_type""",
)
def agg_distinct_exact(spark, sf):
    spec = RollupSpec(
        "users_by_type", ("event_type",), (distinct("users", "user_id"), distinct("ks", "k"))
    )
    return rollup(v.events(spark, sf), spec)


@query("agg_distinct_approx")
def agg_distinct_approx(spark, sf):
    spec = RollupSpec(
        "users_by_type", ("event_type",), (rows("events"), approx("users", "user_id"))
    )
    return rollup(v.events(spark, sf), spec)


@query(
    "agg_distinct_approx_bound",
    """select event_type, count(distinct user_id) as users, true as within_bound
    from events group by event_type""",
)
def agg_distinct_approx_bound(spark, sf):
    """The estimate next to the exact count: within three standard errors of 5 %."""
    spec = RollupSpec(
        "users_by_type",
        ("event_type",),
        (distinct("users", "user_id"), approx("estimate", "user_id")),
    )
    error = F.abs(F.col("estimate") - F.col("users"))
    return rollup(v.events(spark, sf), spec).select(
        "event_type", "users", (error <= 0.15 * F.col("users")).alias("within_bound")
    )


@query(
    "agg_count_if",
    """select event_type, count(*) filter (where value > 50) as high_values,
    count(*) filter (where value < 0) as negative_values from events group by event_type""",
)
def agg_count_if(spark, sf):
    spec = RollupSpec(
        "values_by_type",
        ("event_type",),
        (count_if("high_values", "value > 50"), count_if("negative_values", "value < 0")),
    )
    return rollup(v.events(spark, sf), spec)


def _first_of(keys: str) -> str:
    return with_views(
        f"""select trip_id, event_id, event_ts, ingest_ts, "offset", value from duplicated
        qualify row_number() over (partition by {keys}
            order by ingest_ts, "offset", trip_id, event_id, event_ts, value) = 1""",
        "duplicated",
    )


@query("dedup_id_ts", _first_of("trip_id, event_ts"))
def dedup_id_ts(spark, sf):
    return dedup_events(
        v.duplicated(spark, sf), ("trip_id", "event_ts"), order=("ingest_ts", "offset")
    )


@query("dedup_id", _first_of("event_id"))
def dedup_id(spark, sf):
    return dedup_events(v.duplicated(spark, sf), ("event_id",), order=("ingest_ts", "offset"))


# Ordinary values next to ones far beyond a long of millionths, and far below a millionth.
_WIDE_SQL = """case event_id % 5 when 0 then cast(value as decimal(38,9)) when 1 then 10000000000000
    when 2 then 0.0000004 when 3 then -2500000000000 else 4000000000000 end"""
_WIDE = RollupSpec(
    "wide",
    ("event_type",),
    (rows("records"), mean("mean_value", "wide", scale=9), total("total_value", "wide", scale=9)),
)
_WIDE_ORACLE = with_views(
    f"""select event_type, count(*) as records, cast(sum({_WIDE_SQL}) as double)
        / count({_WIDE_SQL}) as mean_value, cast(sum({_WIDE_SQL}) as double) as total_value
    from ev group by event_type""",
    "ev",
)


def _wide(spark, sf):
    turn = F.col("event_id") % 5
    wide = (
        F.when(turn == 0, F.col("value"))
        .when(turn == 1, 1e13)
        .when(turn == 2, 4e-7)
        .when(turn == 3, -2.5e12)
        .otherwise(4e12)
    )
    return v.events(spark, sf).withColumn("wide", wide)


# Values below a millionth next to ordinary ones, summed by measures as they come. By way of its text a wide
# decimal becomes the nearest double.
_TINY_SQL = """cast(case event_id % 3 when 0 then cast(value as decimal(18,2)) when 1 then 0.0000004
    else 0.00000000025 * k end as decimal(38,15))"""
_TINY = RollupSpec(
    "tiny", ("event_type", "turn"), (rows("records"), mean("mean_value", "tiny"), total("total_value", "tiny"))
)


@query(
    "agg_tiny_values",
    with_views(
        f"""select event_type, event_id % 3 as turn, count(*) as records,
        cast(cast(sum({_TINY_SQL}) as varchar) as double) / count({_TINY_SQL}) as mean_value,
        cast(cast(sum({_TINY_SQL}) as varchar) as double) as total_value
        from ev group by event_type, event_id % 3""",
        "ev",
    ),
)
def agg_tiny_values(spark, sf):
    """Totals and means of values far below a millionth, and of ordinary ones."""
    turn = F.col("event_id") % 3
    small = 2.5e-10 * F.get_json_object("props", "$.k").cast("int")
    tiny = F.when(turn == 0, F.col("value")).when(turn == 1, 4e-7).otherwise(small)
    return rollup(v.events(spark, sf).withColumns({"turn": turn, "tiny": tiny}), _TINY)


@query("agg_wide_values", _WIDE_ORACLE)
def agg_wide_values(spark, sf):
    """Exact totals and means of values of any size and sign."""
    return rollup(_wide(spark, sf), _WIDE)


@query("agg_wide_values_merged", _WIDE_ORACLE)
def agg_wide_values_merged(spark, sf):
    """The same from mergeable partial rows, one for each remainder of the event id."""
    by_part = replace(_WIDE, keys=("event_type", "part"))
    rows_by_part = _wide(spark, sf).withColumn("part", F.col("event_id") % 7)
    return rollup_merge(rollup_partial(rows_by_part, by_part), _WIDE)
