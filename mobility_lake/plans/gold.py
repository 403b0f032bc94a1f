"""The hourly rollups, as specs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mobility_lake import contracts
from mobility_lake.functions.values import clean_label, default_label
from mobility_lake.operators.rollup import (
    RollupSpec,
    approx,
    count_if,
    distinct,
    high,
    latest,
    low,
    mean,
    rows,
    sketch,
    total,
)

HOUR = ("event_date", "event_hour")

_TRIP_MEASURES = (
    rows("records"),
    distinct("distinct_trips", "trip_id", optional=True),
    distinct("distinct_passengers", "passenger_id", optional=True),
    distinct("distinct_drivers", "driver_id", optional=True),
    mean("mean_price", "price", optional=True),
    total("total_price", "price", optional=True),
)
_TRIP_DEFAULTS = {
    "status": ("string", contracts.DEFAULT_STATUS),
    "source": ("string", contracts.DEFAULT_GOLD_SOURCE),
}

TRIPS_HOURLY = RollupSpec(
    "trips_hourly", (*HOUR, "status", "source"), _TRIP_MEASURES, defaults=_TRIP_DEFAULTS
)
TRIPS_YMDH = TRIPS_HOURLY.with_keys(
    "status", "source", "year", "month", "day", "hour", name="trips_ymdh"
)
# Hourly trips with sketches of the ids, from which daily counts come without a look at silver.
TRIPS_SKETCHED = RollupSpec(
    "trips_sketched_hourly",
    TRIPS_HOURLY.keys,
    (
        rows("records"),
        sketch("trips_sketch", "trip_id", optional=True),
        sketch("passengers_sketch", "passenger_id", optional=True),
        sketch("drivers_sketch", "driver_id", optional=True),
        mean("mean_price", "price", optional=True),
        total("total_price", "price", optional=True),
    ),
    defaults=_TRIP_DEFAULTS,
)
TRIPS_DAILY = TRIPS_HOURLY.with_keys("event_date", name="trips_daily")

GPS_HOURLY = RollupSpec(
    "gps_hourly",
    ("city", *HOUR),
    (
        rows("signals"),
        distinct("distinct_vehicles", "vehicle_id"),
        mean("mean_speed", "speed_kmh", optional=True),
        low("min_speed", "speed_kmh", optional=True),
        high("max_speed", "speed_kmh", optional=True),
    ),
    require=("event_ts", "city", "vehicle_id"),
    defaults={"city": ("string", contracts.DEFAULT_CITY), "vehicle_id": ("string", None)},
)

_MOBILITY_KEYS = (*HOUR, "state", "city", "neighbourhood", "vehicle_type")
GPS_MOBILITY_HOURLY = RollupSpec(
    "gps_mobility_hourly",
    _MOBILITY_KEYS,
    (
        rows("signals"),
        approx("distinct_vehicles", "vehicle_id"),
        mean("mean_speed", "speed_kmh"),
        high("max_speed", "speed_kmh"),
        low("min_speed", "speed_kmh"),
        mean("mean_precision", "precision_m"),
    ),
    require=(*_MOBILITY_KEYS, "vehicle_id", "speed_kmh"),
)

WEATHER_HOURLY = RollupSpec(
    "weather_hourly",
    ("city", "condition", *HOUR),
    (
        rows("observations"),
        mean("mean_temperature", "temperature", optional=True),
        high("max_temperature", "temperature", optional=True),
        low("min_temperature", "temperature", optional=True),
        mean("mean_humidity", "humidity", optional=True),
        total("total_rain", "rain", optional=True),
    ),
    defaults={
        "city": ("string", contracts.DEFAULT_CITY),
        "condition": ("string", contracts.DEFAULT_CONDITION),
    },
)

WEATHER_CONDITION_HOURLY = RollupSpec(
    "weather_condition_hourly",
    (*HOUR, "state", "city", "condition"),
    (rows("observations"), approx("distinct_sources", "source")),
    require=(*HOUR, "city"),
)

TRAFFIC_HOURLY = RollupSpec(
    "traffic_hourly",
    ("city", "region_id", "label", *HOUR),
    (
        rows("observations"),
        count_if("observations_with_ratio", "congestion_ratio is not null"),
        mean("mean_ratio", "congestion_ratio"),
        high("max_ratio", "congestion_ratio"),
        low("min_ratio", "congestion_ratio"),
        count_if("errors", "status = 'error'"),
    ),
)



def clean_incidents(df: DataFrame) -> DataFrame:
    """Labels of the hourly incident rollup: cleaned city, spelled-out type and severity."""
    return df.withColumns(
        {
            "city": clean_label(F.col("city")),
            "type": default_label(F.col("type"), contracts.DEFAULT_TYPE),
            "severity": default_label(F.col("severity"), contracts.DEFAULT_SEVERITY),
        }
    )


# Takes rows that went through `clean_incidents`.
INCIDENTS_HOURLY = RollupSpec(
    "incidents_hourly",
    ("city", "type", "severity", *HOUR),
    (rows("incidents"), distinct("distinct_incidents", "incident_id")),
    require=("city", *HOUR),
)

INCIDENTS_DETAIL_HOURLY = RollupSpec(
    "incidents_detail_hourly",
    (*HOUR, "state", "city", "neighbourhood", "type", "severity", "impact"),
    (
        rows("incidents"),
        distinct("distinct_incidents", "incident_id"),
        count_if("lane_closed", "lane_closed"),
        latest("latest_event_ts", "event_ts"),
    ),
    require=("city", "neighbourhood", "type", *HOUR),
)
