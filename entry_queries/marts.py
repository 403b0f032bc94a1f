"""Daily marts, reports, joins and our own summary views."""

from __future__ import annotations

from pyspark.sql import functions as F

from entry_queries import views as v
from entry_queries.registry import query
from entry_queries.views import with_views
from mobility_lake.operators.joins import with_region
from mobility_lake.operators.layout import one_file_each
from mobility_lake.operators.quality import complete_pairs as pairs_of
from mobility_lake.operators.rollup import rollup
from mobility_lake.operators.spine import missing_hours
from mobility_lake.plans import gold
from mobility_lake.plans import marts as m
from mobility_lake.plans import reports
from mobility_lake.sources.lake import lake_read, lake_rebuild, register_view
from mobility_lake.sources.regions import load_regions, valid_regions
from mobility_lake.session import shared_dir


def _mart(spark, sf):
    return m.daily_operations(
        m.stage_trips(v.gold_trips(spark, sf)),
        v.gold_weather(spark, sf),
        v.gold_gps(spark, sf),
        v.gold_traffic(spark, sf),
    )


@query("stage_trips", with_views("select * from staged_trips", "staged_trips"))
def stage_trips(spark, sf):
    return m.stage_trips(v.gold_trips(spark, sf))


@query("stage_traffic", with_views("select * from staged_traffic", "staged_traffic"))
def stage_traffic(spark, sf):
    return m.stage_traffic(v.gold_traffic(spark, sf), v.gold_gps(spark, sf))


@query("stage_weather", with_views("select * from gold_weather", "gold_weather"))
def stage_weather(spark, sf):
    return m.stage_weather(v.gold_weather(spark, sf))


@query(
    "mart_mobility_daily",
    with_views(
        f"""select t.* exclude (date), e.* exclude (event_date) from mobility_daily t
        left join (select event_date, count(distinct trip_id) as total_trips_exact,
            count(distinct passenger_id) as total_passengers_exact,
            count(distinct driver_id) as total_drivers_exact,
            {v.mean('price')} as mean_price_exact from trips group by event_date) e
        on t.date = e.event_date""",
        "mobility_daily",
    ),
)
def mart_mobility_daily(spark, sf):
    return m.mobility_daily(m.stage_trips(v.gold_trips(spark, sf)), v.trips(spark, sf))


@query(
    "mobility_daily_from_sketches",
    with_views(
        """select event_date, count(*) as total_records, count(distinct trip_id) as total_trips,
            count(distinct passenger_id) as total_passengers, count(distinct driver_id) as total_drivers,
            true as within_bound from trips group by event_date""",
        "trips",
    ),
)
def mobility_daily_from_sketches(spark, sf):
    """Daily counts from a stored hourly table with sketches: the exact ones, and whether the estimates are near.

    Within 6 %, three standard errors, and one more for the smallest days.
    """
    path = shared_dir(spark, "sketched")
    lake_rebuild(rollup(v.trips(spark, sf), gold.TRIPS_SKETCHED), path, ("event_date",), one_file_each)
    daily = m.mobility_daily_from_sketches(lake_read(spark, path))
    names = ["total_trips", "total_passengers", "total_drivers"]
    exact = rollup(v.trips(spark, sf), gold.TRIPS_DAILY).select(
        "event_date", *[F.col(n.replace("total", "distinct")).alias(f"_{n}") for n in names]
    )
    near = [F.abs(F.col(n) - F.col(f"_{n}")) <= 0.06 * F.col(f"_{n}") + 1 for n in names]
    both = daily.join(exact, "event_date").withColumn("within_bound", near[0] & near[1] & near[2])
    return both.select("event_date", "total_records", *[F.col(f"_{n}").alias(n) for n in names], "within_bound")


@query(
    "mart_trips_daily",
    with_views(
        f"""select event_date as date, cast(sum(distinct_trips) as bigint) as total_trips,
        {v.total('total_price')} as revenue from gold_trips group by event_date""",
        "gold_trips",
    ),
)
def mart_trips_daily(spark, sf):
    return m.trips_daily(v.gold_trips(spark, sf))


def _congestion(keys: str) -> str:
    return with_views(
        f"""select {keys}, {v.mean('congestion_level', 6)} as mean_congestion,
        {v.mean('mean_speed', 6)} as mean_speed from staged_traffic group by {keys}""",
        "staged_traffic",
    )


@query("mart_congestion_city", _congestion("city"))
def mart_congestion_city(spark, sf):
    return m.congestion(m.stage_traffic(v.gold_traffic(spark, sf), v.gold_gps(spark, sf)))


@query("mart_congestion_city_hour", _congestion("city, event_hour"))
def mart_congestion_city_hour(spark, sf):
    staged = m.stage_traffic(v.gold_traffic(spark, sf), v.gold_gps(spark, sf))
    return m.congestion(staged, ("city", "event_hour"))


@query(
    "mobility_enriched_daily",
    with_views(
        f"""select date, cast(sum(distinct_trips) as bigint) as total_trips,
        {v.total('total_price')} as revenue, any_value(mean_temperature) as mean_temperature,
        any_value(mean_speed) as mean_speed
        from (select *, event_date as date from staged_trips)
        left join weather_daily using (date) left join speed_daily using (date) group by date""",
        "staged_trips",
        "weather_daily",
        "speed_daily",
    ),
)
def mobility_enriched_daily(spark, sf):
    return m.mobility_enriched(
        m.trips_daily(m.stage_trips(v.gold_trips(spark, sf))),
        m.weather_daily(v.gold_weather(spark, sf)),
        m.speed_daily(v.gold_gps(spark, sf)),
    )


@query("daily_operations_mart", with_views("select * from mart order by date", "mart"))
def daily_operations_mart(spark, sf):
    register_view(_mart(spark, sf), "daily_operations")
    return reports.mart_read(spark, "daily_operations")


@query(
    "kpi_summary",
    with_views(
        f"""select cast(sum(total_trips) as bigint) as total_trips,
        {v.total('revenue')} as revenue, {v.mean('mean_ticket', 6)} as mean_ticket,
        {v.mean('mean_temperature', 6)} as mean_temperature from mart""",
        "mart",
    ),
)
def kpi_summary(spark, sf):
    return reports.kpis(_mart(spark, sf))


@query(
    "date_bounds",
    with_views(
        "select min(event_date) as first_date, max(event_date) as last_date from trips", "trips"
    ),
)
def date_bounds(spark, sf):
    return reports.date_bounds(v.trips(spark, sf), "event_date")


@query(
    "mart_ordered",
    with_views(
        f"""select event_date as date, cast(sum(distinct_trips) as bigint) as total_trips,
        {v.total('total_price')} as revenue from gold_trips group by event_date
        order by date desc""",
        "gold_trips",
    ),
)
def mart_ordered(spark, sf):
    return reports.ordered(m.trips_daily(v.gold_trips(spark, sf)), desc=True)


@query("preview_top20", with_views("select * from mart order by date limit 20", "mart"))
def preview_top20(spark, sf):
    return reports.preview(_mart(spark, sf), 20, by=("date",))


@query(
    "series_daily",
    with_views(
        "select date, mean_congestion from mart where mean_congestion is not null", "mart"
    ),
)
def series_daily(spark, sf):
    return reports.series(_mart(spark, sf), "mean_congestion", drop_null=True)


@query(
    "scatter_pairs",
    with_views(
        """select mean_temperature, total_trips from mart where mean_temperature is not null
        and total_trips is not null""",
        "mart",
    ),
)
def scatter_pairs(spark, sf):
    return reports.pairs(_mart(spark, sf), "mean_temperature", "total_trips")


@query(
    "complete_pairs",
    with_views(
        "select city, type from incidents where city is not null and type is not null",
        "incidents",
    ),
)
def complete_pairs(spark, sf):
    return pairs_of(v.incidents(spark, sf), ("city", "type"))


@query("detail_table", with_views("select * from mart", "mart"))
def detail_table(spark, sf):
    return reports.detail_table(_mart(spark, sf))


# --- joins, spine --------------------------------------------------------------------------------


@query(
    "region_dimension",
    with_views(
        """select city, region_id, label, lat, lon,
        case when label is null then 'incomplete' end as reject_reason from regions""",
        "regions",
    ),
)
def region_dimension(spark, sf):
    path = shared_dir(spark, "regions")
    v.region_source(spark, sf).write.json(path)
    valid, rejects = load_regions(spark, path, array=False)
    return valid.withColumn("reject_reason", F.lit(None).cast("string")).unionByName(rejects)


@query(
    "traffic_with_region",
    with_views(
        """select t.event_id, t.region_id, t.city, t.event_ts, r.city as region_city,
        r.label as region_label, r.lat as region_lat, r.lon as region_lon from traffic t
        left join (select * from regions where label is not null) r using (region_id)""",
        "traffic",
        "regions",
    ),
)
def traffic_with_region(spark, sf):
    valid, _ = valid_regions(v.region_source(spark, sf))
    seen = v.traffic(spark, sf).select("event_id", "region_id", "city", "event_ts")
    return with_region(seen, valid)


@query(
    "missing_hours",
    with_views(
        """select city, hour_ts from (select distinct city from gps),
        (select unnest(generate_series(date_trunc('hour', min(event_ts)),
            date_trunc('hour', max(event_ts)), interval 1 hour)) as hour_ts from gps)
        where (city, hour_ts) not in (select (city, date_trunc('hour', event_ts)) from gps)""",
        "gps",
    ),
)
def hours_without_signal(spark, sf):
    signals = v.gps(spark, sf)
    first, last = signals.agg(F.min("event_ts"), F.max("event_ts")).first()
    return missing_hours(signals, first, last, ("city",))


# --- our own definitions -------------------------------------------------------------------------


@query(
    "top_regions",
    with_views(
        "select region_id, count(*) as trips from trips group by region_id "
        "order by trips desc, region_id limit 3",
        "trips",
    ),
)
def top_regions(spark, sf):
    return m.top_regions(v.trips(spark, sf), 3)


@query(
    "geo_grid",
    with_views(
        """select cast(floor(lat * 100) as bigint) as cell_lat,
        cast(floor(lon * 100) as bigint) as cell_lon, count(*) as trips from trips
        group by 1, 2""",
        "trips",
    ),
)
def geo_grid(spark, sf):
    return m.geo_grid(v.trips(spark, sf))


@query(
    "peak_hours",
    with_views(
        """select event_hour, count(*) as trips,
        count(*) / cast(count(distinct event_date) as double) as mean_daily_trips
        from trips group by event_hour""",
        "trips",
    ),
)
def peak_hours(spark, sf):
    return m.peak_hours(v.trips(spark, sf))


@query(
    "weather_impact",
    with_views(
        f"""select condition, count(*) as city_hours, {v.mean('ratio', 6)} as mean_congestion,
        {v.mean('trips', 6)} as mean_trips_per_hour from gold_weather
        left join (select city, event_date, event_hour, {v.mean('mean_ratio', 6)} as ratio
            from gold_traffic group by city, event_date, event_hour)
            using (city, event_date, event_hour)
        left join (select event_date, event_hour, count(*) as trips from trips
            group by event_date, event_hour) using (event_date, event_hour)
        group by condition""",
        "gold_weather",
        "gold_traffic",
        "trips",
    ),
)
def weather_impact(spark, sf):
    return m.weather_impact(
        v.gold_weather(spark, sf), v.gold_traffic(spark, sf), v.gold_trips(spark, sf)
    )


@query(
    "trip_duration",
    with_views(
        """select cast(start_ts as date) as date, count(*) as finished_trips,
        cast(sum(epoch_us(end_ts) - epoch_us(start_ts)) as double) / 1e6 / count(*)
            as mean_seconds
        from (select min(event_ts) as start_ts,
            min(event_ts) filter (where status = 'purchase') as end_ts
            from trips group by trip_id)
        where end_ts is not null group by 1""",
        "trips",
    ),
)
def trip_duration(spark, sf):
    return m.trip_duration(v.trips(spark, sf), ("purchase",))


@query(
    "incidents_by_region",
    with_views(
        """select city, type, severity, cast(sum(incidents) as bigint) as incidents
        from gold_incidents group by city, type, severity""",
        "gold_incidents",
    ),
)
def incidents_by_region(spark, sf):
    return m.incidents_by_region(v.gold_incidents(spark, sf))


@query(
    "mart_trips_by_processing_day",
    with_views(
        f"""select event_date + 1 as date, cast(sum(distinct_trips) as bigint) as total_trips,
        {v.total('total_price')} as revenue from gold_trips group by event_date""",
        "gold_trips",
    ),
)
def trips_by_processing_day(spark, sf):
    """Daily trips by the day the rollup was made, which is the day after the event here."""
    stamp = F.col("event_date").cast("timestamp") + F.expr("interval 30 hours")
    rolled = v.gold_trips(spark, sf).withColumn("gold_process_ts", stamp)
    return m.trips_daily(rolled, date_column="gold_process_ts")
