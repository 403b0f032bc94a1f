"""Daily marts over the hourly rollups. Inputs are small: one row per hour and group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mobility_lake.functions.times import day_of
from mobility_lake.functions.values import cell_of, rounded_mean, rounded_total
from mobility_lake.operators.conform import zero_fill
from mobility_lake.operators.rollup import rollup, united_count
from mobility_lake.plans.gold import TRIPS_DAILY

_TRIP_MEASURES = (
    "records",
    "distinct_trips",
    "distinct_passengers",
    "distinct_drivers",
    "mean_price",
    "total_price",
)


def stage_trips(gold: DataFrame) -> DataFrame:
    """Hourly trips with zero-filled measures, keys as they are."""
    filled = zero_fill(gold, _TRIP_MEASURES)
    keys = [name for name in gold.columns if name not in _TRIP_MEASURES]
    return filled.select(*keys, *_TRIP_MEASURES)


def stage_traffic(gold_traffic: DataFrame, gold_gps: DataFrame | None = None) -> DataFrame:
    """Hourly traffic per city and region: congestion level, and mean speed from GPS if given."""
    extra = [name for name in ("source", "gold_process_ts") if name in gold_traffic.columns]
    traffic = gold_traffic.select(
        "city", "region_id", "label", "event_date", "event_hour", *extra,
        F.col("mean_ratio").alias("congestion_level"),
    )
    if gold_gps is None:
        return traffic.withColumn("mean_speed", F.lit(None).cast("double"))
    speed = gold_gps.select("city", "event_date", "event_hour", "mean_speed")
    return traffic.join(speed, ["city", "event_date", "event_hour"], "left")


def stage_weather(gold_weather: DataFrame) -> DataFrame:
    """Hourly weather as it is."""
    return gold_weather


def mobility_daily(gold: DataFrame, silver: DataFrame | None = None) -> DataFrame:
    """Trips per event day: sums of the hourly measures, mean of the hourly means.

    An id seen in several hours or statuses counts once per hourly row. With `silver`
    the `*_exact` columns count each id once per day and weigh the mean by trips.
    """
    daily = gold.groupBy(
        F.year("event_date").alias("year"),
        F.month("event_date").alias("month"),
        F.dayofmonth("event_date").alias("day"),
    ).agg(
        F.sum("records").alias("total_records"),
        F.sum("distinct_trips").alias("total_trips"),
        F.sum("distinct_passengers").alias("total_passengers"),
        F.sum("distinct_drivers").alias("total_drivers"),
        rounded_total("total_price").alias("total_revenue"),
        rounded_mean("mean_price").alias("mean_price"),
    )
    if silver is None:
        return daily
    exact = rollup(silver, TRIPS_DAILY).select(
        F.year("event_date").alias("year"),
        F.month("event_date").alias("month"),
        F.dayofmonth("event_date").alias("day"),
        F.col("distinct_trips").alias("total_trips_exact"),
        F.col("distinct_passengers").alias("total_passengers_exact"),
        F.col("distinct_drivers").alias("total_drivers_exact"),
        F.col("mean_price").alias("mean_price_exact"),
    )
    return daily.join(exact, ["year", "month", "day"], "left")


_SKETCHES = {"total_trips": "trips_sketch", "total_passengers": "passengers_sketch", "total_drivers": "drivers_sketch"}


def mobility_daily_from_sketches(gold: DataFrame, keys: Sequence[str] = ("event_date",)) -> DataFrame:
    """Rows and distinct trips, people and drivers per day, from hourly gold that carries sketches.

    Sums of hourly distinct counts take an id once for every hour; sketches unite to what the day has
    seen, to about 2 %, and no row of silver is read. Sketches of days unite to weeks in the same way.
    """
    counts = [united_count(column).alias(name) for name, column in _SKETCHES.items()]
    return gold.groupBy(*keys).agg(F.sum("records").alias("total_records"), *counts)


def trips_daily(gold: DataFrame, date_column: str = "event_date") -> DataFrame:
    """Trips and revenue per day of `date_column` (event day, or a processing stamp)."""
    return gold.groupBy(day_of(F.col(date_column)).alias("date")).agg(
        F.sum("distinct_trips").alias("total_trips"),
        rounded_total("total_price").alias("revenue"),
    )


def weather_daily(gold: DataFrame, date_column: str = "event_date") -> DataFrame:
    """Mean of the hourly mean temperatures, and total rain, per day."""
    return gold.groupBy(day_of(F.col(date_column)).alias("date")).agg(
        rounded_mean("mean_temperature").alias("mean_temperature"),
        rounded_total("total_rain").alias("total_rain"),
    )


def speed_daily(gold: DataFrame, date_column: str = "event_date") -> DataFrame:
    """Mean of the hourly mean speeds per day."""
    return gold.groupBy(day_of(F.col(date_column)).alias("date")).agg(
        rounded_mean("mean_speed").alias("mean_speed")
    )


def mobility_enriched(trips: DataFrame, weather: DataFrame, speed: DataFrame) -> DataFrame:
    """Daily trips with that day's weather and traffic speed; NULL on days without."""
    return (
        trips.join(weather.select("date", "mean_temperature"), "date", "left")
        .join(speed.select("date", "mean_speed"), "date", "left")
        .select("date", "total_trips", "revenue", "mean_temperature", "mean_speed")
    )


def congestion(staged: DataFrame, keys: Sequence[str] = ("city",)) -> DataFrame:
    """Mean congestion and speed per key; add `event_hour` for the view by hour."""
    return staged.groupBy(*keys).agg(
        rounded_mean("congestion_level").alias("mean_congestion"),
        rounded_mean("mean_speed").alias("mean_speed"),
    )


def weather_label(has_weather: Column, rain: Column) -> Column:
    """Our own labels: `unknown` without data, `rain` if any fell, else `dry`."""
    return (
        F.when(has_weather.isNull(), "unknown").when(rain > 0, "rain").otherwise("dry")
    )


def traffic_label(ratio: Column) -> Column:
    """Our own labels over the congestion ratio: `unknown`, `free`, `moderate`, `heavy`."""
    return (
        F.when(ratio.isNull(), "unknown")
        .when(ratio < 1.2, "free")
        .when(ratio < 1.5, "moderate")
        .otherwise("heavy")
    )


def daily_operations(
    gold_trips: DataFrame, gold_weather: DataFrame, gold_gps: DataFrame, gold_traffic: DataFrame
) -> DataFrame:
    """One row per day with trips, money, weather and traffic, as the dashboard reads it."""
    trips = (
        mobility_daily(gold_trips)
        .withColumn("date", F.make_date("year", "month", "day"))
        .withColumnRenamed("total_revenue", "revenue")
    )
    weather = weather_daily(gold_weather).withColumn("_weather", F.lit(True))
    jam = gold_traffic.groupBy(F.col("event_date").alias("date")).agg(
        rounded_mean("mean_ratio").alias("mean_congestion")
    )
    joined = (
        trips.join(weather, "date", "left")
        .join(speed_daily(gold_gps), "date", "left")
        .join(jam, "date", "left")
    )
    return joined.select(
        "date",
        "total_trips",
        "total_records",
        "total_passengers",
        "total_drivers",
        "revenue",
        (F.col("revenue") / F.nullif(F.col("total_trips"), F.lit(0))).alias("mean_ticket"),
        "mean_temperature",
        "mean_speed",
        "mean_congestion",
        weather_label(F.col("_weather"), F.col("total_rain")).alias("weather_status"),
        traffic_label(F.col("mean_congestion")).alias("traffic_status"),
    )


# --- views our own definitions give a meaning to -----------------------------------------


def top_regions(trips: DataFrame, n: int, region: str = "region_id") -> DataFrame:
    """The n regions with most trips, ties by region."""
    counted = trips.groupBy(region).agg(F.count("*").alias("trips"))
    return counted.orderBy(F.desc("trips"), region).limit(n)


def geo_grid(trips: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Trips per cell of 0.01 degrees, numbered from south and west.

    For silver trips the coordinates are `origin_lat`, `origin_lon` or those of the destination.
    """
    return trips.groupBy(
        cell_of(F.col(lat)).alias("cell_lat"), cell_of(F.col(lon)).alias("cell_lon")
    ).agg(F.count("*").alias("trips"))


def peak_hours(trips: DataFrame) -> DataFrame:
    """Hours of the day by mean trips per day with data, busiest first."""
    daily = trips.groupBy("event_date", "event_hour").agg(F.count("*").alias("_n"))
    hourly = daily.groupBy("event_hour").agg(
        F.sum("_n").alias("trips"), F.count("*").alias("days")
    )
    return hourly.select(
        "event_hour", "trips", (F.col("trips") / F.col("days")).alias("mean_daily_trips")
    ).orderBy(F.desc("mean_daily_trips"), "event_hour")


def weather_impact(
    gold_weather: DataFrame, gold_traffic: DataFrame, gold_trips: DataFrame
) -> DataFrame:
    """Per weather condition: mean congestion of its city hours and mean trips of its hours.

    All three inputs are rolled up to the grain of the join first, so no key fans out.
    """
    hour = ["event_date", "event_hour"]
    jam = gold_traffic.groupBy("city", *hour).agg(
        rounded_mean("mean_ratio").alias("ratio")
    )
    trips = gold_trips.groupBy(*hour).agg(F.sum("records").alias("trips"))
    hours = gold_weather.select("city", "condition", *hour)
    joined = hours.join(jam, ["city", *hour], "left").join(trips, hour, "left")
    return joined.groupBy("condition").agg(
        F.count("*").alias("city_hours"),
        rounded_mean("ratio").alias("mean_congestion"),
        rounded_mean("trips").alias("mean_trips_per_hour"),
    )


def trip_duration(trips: DataFrame, terminal: Sequence[str]) -> DataFrame:
    """Mean seconds from a trip's first event to its first terminal status, per start day."""
    done = F.when(F.col("status").isin(*terminal), F.col("event_ts"))
    spans = (
        trips.groupBy("trip_id")
        .agg(F.min("event_ts").alias("_start"), F.min(done).alias("_end"))
        .filter(F.col("_end").isNotNull())
    )
    seconds = (F.unix_micros("_end") - F.unix_micros("_start")) / F.lit(1_000_000.0)
    return (
        spans.withColumn("_seconds", seconds)
        .groupBy(F.to_date("_start").alias("date"))
        .agg(
            F.count("*").alias("finished_trips"),
            rounded_mean("_seconds").alias("mean_seconds"),
        )
    )


def incidents_by_region(gold_incidents: DataFrame, region: str = "city") -> DataFrame:
    """Hourly incident counts summed per region, type and severity."""
    return gold_incidents.groupBy(region, "type", "severity").agg(
        F.sum("incidents").alias("incidents")
    )
