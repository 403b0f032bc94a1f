"""Bronze to silver: conformed rows, each with a reject reason or NULL.

`mark_*` keeps every row, so good rows and rejects come from one definition:
`quality.accepted(mark_trips(bronze))` is the silver table, `quality.rejected(...)` the
rejects. Deduplication follows on the good rows only (see `plans.feeds`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mobility_lake import contracts
from mobility_lake.functions.times import parse_event_time
from mobility_lake.functions.values import grid_cell, to_number
from mobility_lake.operators.conform import (
    JSON_FIELD,
    WEATHER_OBJECT,
    conform,
    ensure_columns,
    pick_fields,
    rename_if_absent,
    resolve_alias,
    resolve_event_time,
    stamp,
    weather_word,
    with_event_calendar,
    with_weather_object,
)
from mobility_lake.operators.quality import REASON, missing, missing_every, with_reason


def _finish(df: DataFrame, rules: dict, table: str) -> DataFrame:
    marked = with_reason(df, rules)
    if "silver_process_ts" in contracts.SILVER[table].names:
        marked = stamp(marked, "silver_process_ts")
    schema = contracts.SILVER[table]
    return conform(marked, T.StructType([*schema.fields, T.StructField(REASON, T.StringType())]))


def mark_trips(
    bronze: DataFrame,
    default_status: str = contracts.DEFAULT_STATUS,
    default_source: str = contracts.DEFAULT_SOURCE,
    now_if_missing: bool = False,
) -> DataFrame:
    """Trips from columns where they exist, else from the payload, in either spelling.

    The region of a trip is the grid cell of its origin.
    """
    df = bronze
    if "value" in df.columns:
        df = pick_fields(df, contracts.TRIP_PAYLOAD.names)
    defaults = {"status": default_status, "source": default_source}
    picked = {}
    for name, spellings in contracts.TRIP_ALIASES.items():
        dtype = "double" if name == "price" else "string"
        columns = (name, *[s for s in spellings if s != name])
        picked[name] = resolve_alias(df, columns, spellings, dtype, defaults.get(name))
    picked["price"] = to_number(picked["price"])
    for name, spellings in contracts.TRIP_PLACES.items():
        picked[name] = to_number(resolve_alias(df, (name, *spellings), spellings, "double"))
    picked["region_id"] = grid_cell(picked["origin_lat"], picked["origin_lon"])
    picked["event_ts"] = resolve_event_time(
        df,
        (
            "event_ts",
            "ts_evento_ts",
            "ts_evento",
            JSON_FIELD + "ts_evento",
            "broker_ts",
            "ingest_ts",
        ),
        now_if_missing,
    )
    picked["ingest_ts"] = F.coalesce(
        F.col("ingest_ts") if "ingest_ts" in df.columns else F.lit(None), F.current_timestamp()
    )
    rows = with_event_calendar(df.withColumns(picked), ("year", "month", "day", "hour"))
    rules = {"no event time": missing("event_ts"), "no trip id": missing("trip_id")}
    return _finish(rows, rules, "trips")


def _or_now(bronze: DataFrame, now_if_missing: bool) -> DataFrame:
    """With a missing event time set to the processing time, where that is asked for."""
    if not now_if_missing:
        return bronze
    return bronze.withColumn("event_ts", F.coalesce("event_ts", F.current_timestamp()))


def mark_gps(bronze: DataFrame, now_if_missing: bool = False) -> DataFrame:
    """GPS signals; a signal needs an event time and a vehicle or a city."""
    names = {wire: name for name, wire in contracts.WIRE_NAMES["silver.gps"].items()}
    df = rename_if_absent(
        bronze, {**names, "clima": "weather_condition", "velocidade": "speed_kmh"}
    )
    wanted = {
        field.name: (field.dataType.simpleString(), None)
        for field in contracts.SILVER["gps"]
        if field.name not in ("silver_process_ts", "event_date", "event_hour")
    }
    rows = with_event_calendar(_or_now(ensure_columns(df, wanted), now_if_missing))
    rules = {
        "no event time": missing("event_ts"),
        "no vehicle and no city": missing_every("vehicle_id", "city"),
    }
    return _finish(rows, rules, "gps")


def mark_weather(bronze: DataFrame, now_if_missing: bool = False) -> DataFrame:
    """Weather observations; the weather field is a word or an object with measures."""
    parsed = with_weather_object(_or_now(bronze, now_if_missing), "weather", contracts.WEATHER_OBJECT)
    inner = F.col(WEATHER_OBJECT)
    rows = with_event_calendar(
        parsed.withColumns(
            {
                "condition": weather_word("weather"),
                "temperature": inner["temperatura_c"],
                "humidity": F.lit(None).cast("double"),
                "rain": inner["chuva_mm_h"],
            }
        )
    )
    rules = {
        "no event time": missing("event_ts"),
        "no state": missing("state"),
        "no city": missing("city"),
    }
    return _finish(rows, rules, "weather")


def mark_traffic(bronze: DataFrame, now_if_missing: bool = False) -> DataFrame:
    """Traffic observations from the payload, parsed once."""
    parsed = pick_fields(_or_now(bronze, now_if_missing), contracts.TRAFFIC_FIELDS)

    def text(name):
        return F.col(JSON_FIELD + name)

    rows = with_event_calendar(
        parsed.withColumns(
            {
                "event_id": text("event_id"),
                "type": text("tipo"),
                "provider": text("provider"),
                "city": text("city"),
                "region_id": text("region_id"),
                "label": text("label"),
                "point_lat": to_number(text("point_lat")),
                "point_lon": to_number(text("point_lon")),
                "event_ts_text": text("ts_evento"),
                "collected_ts": parse_event_time(text("ts_coleta")),
                "status": text("status"),
                "error_message": text("error_message"),
                "congestion_ratio": to_number(text("congestion_ratio")),
            }
        )
    )
    rules = {
        "no event time": missing("event_ts"),
        "no city": missing("city"),
        "no event id": missing("event_id"),
    }
    return _finish(rows, rules, "traffic")


def mark_incidents(bronze: DataFrame, now_if_missing: bool = False) -> DataFrame:
    """Incidents; rows without an id are rejected so that they cannot merge as duplicates."""
    event_ts = resolve_event_time(bronze, ("event_ts", "event_ts_text"), now_if_missing)
    rows = with_event_calendar(bronze.withColumn("event_ts", event_ts))
    rules = {"no event time": missing("event_ts"), "no incident id": missing("incident_id")}
    return _finish(rows, rules, "incidents")


MARK = {
    "trips": mark_trips,
    "gps": mark_gps,
    "incidents": mark_incidents,
    "weather": mark_weather,
    "traffic": mark_traffic,
}
