"""Broker records to bronze tables: raw or typed, with event time and event date.

Nothing is dropped here; a record that cannot be read keeps NULL fields and lands in
the NULL date partition. The payload is parsed once per record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mobility_lake import contracts
from mobility_lake.functions.times import parse_event_time
from mobility_lake.functions.values import json_pick
from mobility_lake.operators.conform import (
    WEATHER_OBJECT,
    conform,
    parsed_once,
    resolve_alias,
    weather_word,
    with_event_date,
    with_weather_object,
)
from mobility_lake.sources.broker import record_envelope


def _raw(records: DataFrame) -> DataFrame:
    return record_envelope(records).withColumn(
        "event_ts_text", json_pick(F.col("value"), "$.ts_evento")
    ).withColumn("event_ts", parse_event_time(F.col("event_ts_text")))


def bronze_trips(records: DataFrame) -> DataFrame:
    return conform(with_event_date(_raw(records)), contracts.BRONZE["trips"])


def bronze_traffic(records: DataFrame) -> DataFrame:
    return conform(with_event_date(_raw(records)), contracts.BRONZE["traffic"])


def _typed(records: DataFrame, schema) -> DataFrame:
    return records.select(
        F.col("value").cast("string").alias("raw_json"),
        F.col("timestamp").alias("broker_ts"),
        parsed_once(F.col("value").cast("string"), schema).alias("value"),
    )


def _renamed(df: DataFrame, aliases: dict, **others: str | Column) -> DataFrame:
    columns = {
        name: resolve_alias(df, json_fields=fields) for name, fields in aliases.items()
    }
    for name, source in others.items():
        columns[name] = F.col(f"value.{source}") if isinstance(source, str) else source
    return df.withColumns(columns)


def _timed(df: DataFrame) -> DataFrame:
    return with_event_date(df.withColumn("event_ts", parse_event_time(F.col("event_ts_text"))))


def bronze_gps(records: DataFrame) -> DataFrame:
    parsed = _typed(records, contracts.GPS_PAYLOAD)
    parsed = with_weather_object(parsed, "value.clima", contracts.WEATHER_OBJECT)
    inner = F.col(WEATHER_OBJECT)
    columns = _renamed(
        parsed,
        contracts.GPS_ALIASES,
        event_ts_text="ts_evento",
        vehicle_type="tipo_veiculo",
        line="linha",
        state="estado",
        city="cidade",
        neighbourhood="bairro",
        latitude="latitude",
        longitude="longitude",
        heading_deg="rumo_graus",
        precision_m="precisao_m",
        signal_status="status_sinal",
        weather_condition=weather_word("value.clima"),
        weather_temperature_c=inner["temperatura_c"],
        weather_rain_mm_h=inner["chuva_mm_h"],
        weather_visibility_m=inner["visibilidade_m"],
    )
    return conform(_timed(columns), contracts.BRONZE["gps"])


def bronze_incidents(records: DataFrame) -> DataFrame:
    columns = _renamed(
        _typed(records, contracts.INCIDENT_PAYLOAD),
        contracts.INCIDENT_ALIASES,
        event_ts_text="ts_evento",
        state="estado",
        city="cidade",
        neighbourhood="bairro",
        latitude="latitude",
        longitude="longitude",
        lane_closed="faixa_interditada",
        impact="impacto",
        source="fonte",
    )
    return conform(_timed(columns), contracts.BRONZE["incidents"])


def bronze_weather(records: DataFrame) -> DataFrame:
    columns = _renamed(
        _typed(records, contracts.WEATHER_PAYLOAD),
        {},
        event_ts_text="ts_evento",
        state="estado",
        city="cidade",
        latitude="latitude",
        longitude="longitude",
        source="fonte",
        weather="clima",
    )
    return conform(_timed(columns), contracts.BRONZE["weather"])


BRONZE = {
    "trips": bronze_trips,
    "gps": bronze_gps,
    "incidents": bronze_incidents,
    "weather": bronze_weather,
    "traffic": bronze_traffic,
}
