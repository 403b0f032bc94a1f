import datetime as dt

import pytest
from helpers import at, records, same_rows
from pyspark.sql import functions as F

from mobility_lake import contracts
from mobility_lake.operators.quality import REASON, accepted, rejected
from mobility_lake.operators.rollup import rollup
from mobility_lake.plans import gold
from mobility_lake.plans.bronze import BRONZE
from mobility_lake.plans.silver import MARK, mark_gps, mark_trips

TS = '"ts_evento": "2024-01-02T06:00:00Z"'


def marked(spark, feed, *payloads):
    return MARK[feed](BRONZE[feed](records(spark, payloads)))


def reasons(df):
    return [r[REASON] for r in df.select(REASON).collect()]


@pytest.mark.parametrize("feed", list(BRONZE))
def test_contracts_and_malformed_records(spark, feed):
    bronze = BRONZE[feed](records(spark, ["{bad", "{}", "[1]"]))
    assert bronze.schema.names == contracts.BRONZE[feed].names
    assert [r["event_date"] for r in bronze.collect()] == [None, None, None]
    out = MARK[feed](bronze)
    assert out.schema.names == [*contracts.SILVER[feed].names, REASON]
    assert accepted(out).count() == 0 and rejected(out).count() == 3


def test_trips_accept_both_spellings(spark):
    out = accepted(
        marked(
            spark, "trips",
            f'{{{TS}, "id_viagem": "t1", "id_passageiro": "p", "id_motorista": "d", "preco": 12.50, "status": "criada", "fonte": "app"}}',
            f'{{{TS}, "viagem_id": "t2", "passageiro_id": "p", "motorista_id": "d", "preco_estimado": "9.5"}}',
            '{"id_viagem": "t3", "ts_evento": "junk", "preco": "abc"}',
        )
    )
    rows = {r["trip_id"]: r for r in out.collect()}
    assert (rows["t1"]["price"], rows["t1"]["status"], rows["t1"]["source"]) == (12.5, "criada", "app")
    assert (rows["t2"]["price"], rows["t2"]["status"], rows["t2"]["source"]) == (
        9.5, contracts.DEFAULT_STATUS, contracts.DEFAULT_SOURCE,
    )
    assert (rows["t1"]["year"], rows["t1"]["month"], rows["t1"]["day"], rows["t1"]["hour"]) == (2024, 1, 2, 6)
    assert rows["t3"]["price"] is None and (rows["t3"]["month"], rows["t3"]["day"]) == (5, 1)


def test_trips_from_a_table_that_already_has_columns(spark):
    df = spark.createDataFrame(
        [("t", 3.0, "2024-01-02 06:00:00"), (None, 1.0, "2024-01-02 06:00:00"), ("u", 1.0, None)],
        "viagem_id string, preco double, ts_evento string",
    )
    out = mark_trips(df)
    assert reasons(out) == [None, "no trip id", "no event time"]
    assert reasons(mark_trips(df, now_if_missing=True)) == [None, "no trip id", None]
    assert accepted(out).first()["price"] == 3.0


def test_gps_accepts_producer_and_ingest_spellings(spark):
    out = marked(
        spark, "gps",
        f'{{{TS}, "id_motorista": "v1", "velocidade": 40.5, "fonte": "sim", "clima": "sol"}}',
        f'{{{TS}, "veiculo_id": "v2", "velocidade_kmh": 50, "fonte_gps": "gps", "cidade": "X", '
        '"precisao_m": 30.5, "clima": {"condicao": "chuva", "temperatura_c": 20.5, "visibilidade_m": 900}}',
        f'{{{TS}, "cidade": "Y"}}',
        f"{{{TS}}}",
        '{"veiculo_id": "v3"}',
    )
    rows = out.collect()
    assert [r[REASON] for r in rows] == [None, None, None, "no vehicle and no city", "no event time"]
    assert (rows[0]["vehicle_id"], rows[0]["speed_kmh"], rows[0]["source"]) == ("v1", 40.5, "sim")
    assert rows[0]["weather_condition"] == "sol" and rows[0]["weather_temperature_c"] is None
    assert (rows[1]["vehicle_id"], rows[1]["speed_kmh"], rows[1]["precision_m"]) == ("v2", 50.0, None)
    assert (rows[1]["weather_condition"], rows[1]["weather_temperature_c"], rows[1]["weather_visibility_m"]) == (
        "chuva", 20.5, 900,
    )


def test_gps_from_a_table_with_few_columns(spark):
    df = spark.createDataFrame(
        [(at("2024-01-02 06:00:00"), "sol", 40.0)], "ts_evento timestamp, clima string, velocidade double"
    )
    row = mark_gps(df.withColumn("cidade", F.lit("X"))).first()
    assert (row["weather_condition"], row["speed_kmh"], row["city"], row[REASON]) == ("sol", 40.0, "X", None)


def test_weather_as_word_or_object(spark):
    place = '"estado": "SP", "cidade": "X"'
    out = marked(
        spark, "weather",
        f'{{{TS}, {place}, "clima": "sol"}}',
        f'{{{TS}, {place}, "clima": {{"condicao": "chuva", "temperatura_c": 18.5, "chuva_mm_h": 2}}}}',
        f'{{{TS}, "cidade": "X", "clima": "sol"}}',
        f'{{{TS}, "estado": "SP", "clima": "sol"}}',
    )
    rows = out.collect()
    assert [r[REASON] for r in rows] == [None, None, "no state", "no city"]
    assert (rows[0]["condition"], rows[0]["temperature"]) == ("sol", None)
    assert (rows[1]["condition"], rows[1]["temperature"], rows[1]["rain"]) == ("chuva", 18.5, 2.0)
    assert (rows[1]["event_date"], rows[1]["event_hour"]) == (dt.date(2024, 1, 2), 6)


def test_incident_spellings_and_missing_ids(spark):
    out = marked(
        spark, "incidents",
        f'{{{TS}, "id_incidente": "i1", "tipo": "pane", "gravidade": "alta"}}',
        f'{{{TS}, "incidente_id": "i2", "tipo_incidente": "pane", "severidade": "alta", "faixa_interditada": true}}',
        f'{{{TS}, "tipo": "pane"}}',
        f'{{{TS}, "tipo": "pane"}}',
    )
    rows = out.collect()
    assert [r[REASON] for r in rows] == [None, None, "no incident id", "no incident id"]
    assert [(r["incident_id"], r["type"], r["severity"]) for r in rows[:2]] == [
        ("i1", "pane", "alta"), ("i2", "pane", "alta"),
    ]
    assert rows[1]["lane_closed"] is True


def test_traffic_fields(spark):
    out = marked(
        spark, "traffic",
        f'{{{TS}, "event_id": "e", "city": "X", "region_id": "r", "status": "ok", "point_lat": -23.5, '
        '"ts_coleta": "2024-01-02T06:00:05Z", "congestion_ratio": 1.25}',
        f'{{{TS}, "event_id": "e", "status": "error"}}',
        f'{{{TS}, "city": "X", "status": "error", "congestion_ratio": null}}',
    )
    rows = out.collect()
    assert [r[REASON] for r in rows] == [None, "no city", "no event id"]
    assert (rows[0]["point_lat"], rows[0]["congestion_ratio"], rows[0]["provider"]) == (-23.5, 1.25, None)
    assert rows[0]["collected_ts"] is not None


def test_silver_in_wire_spelling_reads_back(spark):
    silver = accepted(marked(spark, "trips", f'{{{TS}, "id_viagem": "t1", "preco": 5}}'))
    wire = contracts.to_wire(silver, "silver.trips")
    assert {"id_viagem", "preco", "fonte", "ano"} <= set(wire.columns)
    assert same_rows(contracts.from_wire(wire, "silver.trips").drop("ingest_ts"), silver.drop("ingest_ts"))


def test_mobility_rollup_requires_every_key(spark):
    rows = accepted(
        marked(
            spark, "gps",
            f'{{{TS}, "veiculo_id": "v", "velocidade": 10, "estado": "S", "cidade": "C", "bairro": "B", "tipo_veiculo": "bus"}}',
            f'{{{TS}, "veiculo_id": "v", "velocidade": 10, "estado": "S", "cidade": "C", "tipo_veiculo": "bus"}}',
        )
    )
    assert rollup(rows, gold.GPS_MOBILITY_HOURLY).count() == 1
    assert rollup(rows, gold.GPS_HOURLY).first()["signals"] == 2
