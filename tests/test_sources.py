import datetime as dt
import json

import pytest
from helpers import NOW, records
from pyspark.sql import functions as F

from mobility_lake import contracts, session
from mobility_lake.catalog import Lake
from mobility_lake.sources import broker
from mobility_lake.sources.lake import (
    file_inventory,
    lake_append_stream,
    lake_read,
    lake_rebuild,
    lake_replace_partitions,
    lake_stream,
    path_exists,
    register_view,
    stored_schema,
)
from mobility_lake.sources.landing import load_by_name, load_new_files, load_report
from mobility_lake.sources.regions import load_regions, valid_regions
from mobility_lake.plans import gold, reports
from mobility_lake.operators.rollup import rollup


def test_broker_options():
    options = broker.reader_options(
        "host:1",
        "trips",
        starting_offsets="earliest",
        options={
            "security.protocol": "SASL_SSL",
            "kafka.sasl.mechanism": "X",
            "bootstrap.servers": "evil:1",
        },
        max_offsets=20_000,
        fail_on_data_loss=False,
    )
    assert options == {
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": "X",
        "kafka.bootstrap.servers": "host:1",
        "subscribe": "trips",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "20000",
        "failOnDataLoss": "false",
    }
    assert "failOnDataLoss" not in broker.reader_options("h", "t")
    with pytest.raises(ValueError):
        broker.reader_options("h", "t", starting_offsets="middle")


def test_record_envelope(spark):
    row = broker.record_envelope(records(spark, ['{"a": 1}'])).first()
    assert (row["key"], row["value"], row["offset"]) == ("0", '{"a": 1}', 0)
    assert row["ingest_ts"] is not None


def days(spark, *numbers):
    rows = [(n, dt.date(2024, 1, n)) for n in numbers]
    return spark.createDataFrame(rows, "n int, event_date date")


def test_rebuild_replaces_everything_even_in_a_dynamic_session(spark, folder):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        lake_rebuild(days(spark, 1, 2), folder + "/t", ("event_date",))
        lake_rebuild(days(spark, 2, 3), folder + "/t", ("event_date",))
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert sorted(r["n"] for r in lake_read(spark, folder + "/t").collect()) == [2, 3]
    lake_rebuild(days(spark, 4), folder + "/flat")
    lake_rebuild(days(spark, 5), folder + "/flat")
    assert [r["n"] for r in lake_read(spark, folder + "/flat").collect()] == [5]


def test_replace_partitions_leaves_others(spark, folder):
    lake_rebuild(days(spark, 1, 2), folder + "/t", ("event_date",))
    changed = days(spark, 2).withColumn("n", F.lit(20))
    lake_replace_partitions(changed, folder + "/t", ("event_date",))
    assert sorted(r["n"] for r in lake_read(spark, folder + "/t").collect()) == [1, 20]


def test_scan_prunes_partitions_and_columns(spark, folder):
    lake_rebuild(days(spark, 1, 2, 3).withColumn("wide", F.lit("w")), folder + "/t", ("event_date",))
    read = lake_read(spark, folder + "/t").filter("event_date = date '2024-01-02' and n > 0")
    plan = read.select("n")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert "GreaterThan(n,0)" in plan and "ReadSchema: struct<n:int>" in plan


def test_borrowed_schema_contract_and_empty_lake(spark, folder):
    path = folder + "/t"
    assert stored_schema(spark, path) is None and not path_exists(spark, path)
    with pytest.raises(ValueError):
        lake_stream(spark, path)
    contract = days(spark, 1).schema
    (days(spark, 1)).write.parquet(path)
    assert path_exists(spark, path)
    assert lake_stream(spark, path).schema == stored_schema(spark, path)
    empty = folder + "/empty"
    days(spark, 1).write.parquet(empty + "/_hidden")
    assert lake_stream(spark, empty, contract=contract).schema == contract


def test_file_cap_trigger_name_and_resume(spark, folder):
    source, target, checkpoint = (f"{folder}/{n}" for n in ("in", "out", "ck"))
    for n in (1, 2, 3):
        days(spark, n).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = lake_stream(spark, source, days(spark, 1).schema, max_files=1)
        query = lake_append_stream(stream, target, checkpoint, ("event_date",), NOW, "capped")
        assert query.name == "capped"
        query.awaitTermination()
        return [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]

    assert run() == [1, 1, 1]
    days(spark, 4).coalesce(1).write.mode("append").parquet(source)
    assert run() == [1]
    assert sorted(r["n"] for r in lake_read(spark, target).collect()) == [1, 2, 3, 4]


def test_file_inventory(spark, folder):
    days(spark, 1, 1, 2).coalesce(1).write.partitionBy("event_date").parquet(folder + "/t")
    found = file_inventory(lake_read(spark, folder + "/t"), ("event_date",)).collect()
    assert {(r["event_date"].day, r["files"], r["records"]) for r in found} == {(1, 1, 2), (2, 1, 1)}
    assert all(r["bytes"] > 0 for r in found)


def test_load_by_name(spark):
    df = spark.createDataFrame([("a", "7", 1)], "Status string, qtd_Registros string, extra int")
    target = contracts.LANDING["trips_hourly"]
    loaded = load_by_name(df, target)
    assert loaded.schema.names == target.names
    assert [f.dataType for f in loaded.schema] == [f.dataType for f in target]
    row = loaded.first()
    assert (row["STATUS"], row["QTD_REGISTROS"], row["FONTE"]) == ("a", 7, None)
    report = load_report(df, target)
    assert report["dropped"] == ["extra"] and "FONTE" in report["unfilled"]


def test_landing_tables_fill_from_gold_in_wire_spelling(spark):
    rows = spark.createDataFrame(
        [("X", "rain", dt.date(2024, 1, 1), 3, 20.0, 60.0, 1.5)],
        "city string, condition string, event_date date, event_hour int, temperature double, "
        "humidity double, rain double",
    )
    wire = contracts.to_wire(rollup(rows, gold.WEATHER_HOURLY), "gold.weather_hourly")
    loaded = load_by_name(
        wire, contracts.LANDING["weather_hourly"], contracts.LANDING_SOURCES["weather_hourly"]
    ).first()
    assert (loaded["CIDADE"], loaded["CHUVA_MM"], loaded["CONDICAO"]) == ("X", 1.5, "rain")
    back = contracts.from_wire(wire, "gold.weather_hourly")
    assert set(back.columns) == set(gold.WEATHER_HOURLY.columns)


def test_files_are_loaded_once(spark, folder):
    target = contracts.LANDING["incidents_hourly"]
    source, table, checkpoint = (f"{folder}/{n}" for n in ("in", "out", "ck"))

    def deliver_and_load(city):
        row = spark.createDataFrame([(city, "x", 2)], "cidade string, tipo string, qtd_incidentes int")
        row.coalesce(1).write.mode("append").parquet(source)
        load_new_files(
            spark, source, table, checkpoint, target, contracts.LANDING_SOURCES["incidents_hourly"]
        ).awaitTermination()
        return sorted((r["CIDADE"], r["QUANTIDADE"]) for r in spark.read.parquet(table).collect())

    assert deliver_and_load("a") == [("a", 2)]
    assert deliver_and_load("b") == [("a", 2), ("b", 2)]


def test_regions_from_array_and_lines(spark, folder):
    full = {"city": "X", "region_id": "r1", "label": "L", "lat": -1.5, "lon": 2.5}
    partial = {k: v for k, v in full.items() if k != "label"}
    (array := folder + "/array.json")
    with open(array, "w") as f:
        json.dump([full, partial], f)
    with open(folder + "/lines.json", "w") as f:
        f.write(json.dumps(full) + "\n" + json.dumps(partial) + "\n")
    for valid, rejects in (
        load_regions(spark, array),
        load_regions(spark, folder + "/lines.json", array=False),
    ):
        assert [r.asDict() for r in valid.collect()] == [full]
        assert [r["reject_reason"] for r in rejects.collect()] == ["incomplete"]


def test_view_and_mart_read(spark):
    register_view(spark.createDataFrame([(2,), (1,)], "date int"), "some_mart")
    assert [r[0] for r in reports.mart_read(spark, "some_mart").collect()] == [1, 2]


def test_catalog_and_session(spark):
    lake = Lake("s3://x/")
    assert lake.table("gold", "t") == "s3://x/gold/t"
    assert lake.checkpoint("gold", "t") == "s3://x/checkpoints/gold/t"
    with pytest.raises(ValueError):
        lake.table("platinum", "t")
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = session.shared_dir(spark, "a"), session.shared_dir(spark, "a")
    assert first.startswith(shared) and first != second
    assert session.shuffle_partitions(10 << 40, 4000) == 81_920
    assert session.shuffle_partitions(0, 8) == 16
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    assert session.pin(spark).conf.get("spark.sql.session.timeZone") == "UTC"


def test_repeated_regions_are_rejected(spark):
    rows = [("A", "r1", "x", 1.0, 2.0), ("B", "r1", "x", 1.0, 2.0), ("A", "r1", "x", 1.0, 2.0), ("C", "r2", None, 1.0, 2.0),
            ("C", "r2", "y", 3.0, 4.0)]
    valid, rejects = valid_regions(spark.createDataFrame(rows, contracts.REGIONS))
    assert sorted((r["city"], r["region_id"]) for r in valid.collect()) == [("A", "r1"), ("C", "r2")]
    found = sorted((r["city"], r["reject_reason"]) for r in rejects.collect())
    assert found == [("A", "repeated id"), ("B", "repeated id"), ("C", "incomplete")]
