import datetime as dt

import pytest
from helpers import at, same_rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mobility_lake import contracts
from mobility_lake.operators import conform as c
from mobility_lake.operators import quality as q
from mobility_lake.operators.dedup import dedup_events
from mobility_lake.operators.joins import with_region
from mobility_lake.operators.layout import lay_out, lay_out_stream, one_file_each
from mobility_lake.operators.rollup import (
    RollupSpec,
    approx,
    count_if,
    distinct,
    high,
    latest,
    low,
    mean,
    rollup,
    rollup_merge,
    rollup_partial,
    rows,
    total,
)
from mobility_lake.operators.spine import hour_spine, missing_hours
from mobility_lake.plans import gold


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


# --- conform -----------------------------------------------------------------------------------


def test_parse_payload_keeps_rows_and_other_fields(spark):
    schema = T.StructType(
        [T.StructField("a", T.IntegerType()), T.StructField("clima", contracts.WEATHER_OBJECT)]
    )
    df = frame(
        spark,
        [(1, "{bad"), (2, '{"a": 5, "clima": "sol"}'), (3, '{"a": 30.5}'), (4, None)],
        "id int, value string",
    )
    parsed = {r["id"]: r for r in c.parse_payload(df, schema, keep=("id",)).collect()}
    assert len(parsed) == 4
    assert parsed[1]["a"] is None and parsed[4]["a"] is None
    assert parsed[2]["a"] == 5 and parsed[2]["clima"] is None
    assert parsed[3]["a"] is None


def test_resolve_alias_prefers_columns_then_json_then_default(spark):
    df = frame(
        spark,
        [("c", '{"x": "j"}'), (None, '{"x": "j", "y": "k"}'), (None, '{"y": "k"}'), (None, "{")],
        "col string, value string",
    )
    picked = c.resolve_alias(df, ("absent", "col"), ("x", "y"), default="d").alias("v")
    assert [r["v"] for r in df.select(picked).collect()] == ["c", "j", "k", "d"]
    ready = c.pick_fields(df, ("x", "y"))
    again = c.resolve_alias(ready, ("col",), ("x", "y"), default="d").alias("v")
    assert [r["v"] for r in ready.select(again).collect()] == ["c", "j", "k", "d"]


def test_resolve_event_time_order_and_fallback(spark):
    df = frame(
        spark,
        [(at("2024-01-01 00:00:00"), "2024-01-02T00:00:00Z", at("2024-01-03 00:00:00")),
         (None, "2024-01-02T00:00:00Z", at("2024-01-03 00:00:00")),
         (None, "junk", at("2024-01-03 00:00:00")),
         (None, "junk", None)],
        "event_ts timestamp, text string, broker_ts timestamp",
    )
    day = F.dayofmonth(c.resolve_event_time(df, ("event_ts", "text", "nope", "broker_ts")))
    assert [r[0] for r in df.select(day).collect()] == [1, 2, 3, None]
    now = c.resolve_event_time(df, ("event_ts", "text", "broker_ts"), now_if_missing=True)
    assert df.filter(now.isNull()).count() == 0


def test_calendar_and_date_from_parts(spark):
    df = frame(spark, [(at("2024-02-29 23:59:59"),)], "event_ts timestamp")
    row = c.with_event_calendar(df, tuple(c.CALENDAR)).first()
    assert row["event_date"] == dt.date(2024, 2, 29)
    assert (row["year"], row["month"], row["day"], row["hour"], row["event_hour"]) == (
        2024, 2, 29, 23, 23,
    )
    parts = frame(spark, [(2024, 2, 29, 7)], "year int, month int, day int, hour int")
    assert c.event_date_from_parts(parts).first()["event_date"] == dt.date(2024, 2, 29)
    ready = frame(spark, [("2024-02-29", "7")], "event_date string, event_hour string")
    assert c.event_date_from_parts(ready).first()[:2] == (dt.date(2024, 2, 29), 7)
    with pytest.raises(ValueError):
        c.event_date_from_parts(df)


def test_ensure_rename_spellings(spark):
    df = frame(spark, [(1, 2, 3)], "velocidade int, clima int, city int")
    renamed = c.rename_if_absent(
        df, {"velocidade": "speed_kmh", "clima": "city", "gone": "x", "city": "speed_kmh"}
    )
    assert renamed.columns == ["speed_kmh", "clima", "city"]
    filled = c.ensure_columns(df, {"city": ("string", "no"), "new": ("double", None)})
    assert filled.dtypes[-1] == ("new", "double") and filled.first()["city"] == 3
    assert c.first_existing(df, ("x", "clima", "city")) == "clima"
    assert c.first_existing(df, ("x",)) is None
    trips = frame(spark, [(1, 2)], "viagem_id int, valor int")
    assert c.pick_spellings(trips, contracts.TRIP_COLUMN_NAMES).columns == ["trip_id", "price"]


def test_conform_is_strict_about_missing_columns(spark):
    df = frame(spark, [("1", "x")], "b string, extra string")
    schema = T.StructType([T.StructField("b", T.IntegerType())])
    assert c.conform(df, schema).dtypes == [("b", "int")]
    with pytest.raises(Exception, match="gone"):
        c.conform(df, T.StructType([T.StructField("gone", T.IntegerType())])).collect()


def test_zero_fill_and_stamp(spark):
    df = frame(spark, [(None, None)], "a bigint, b double")
    row = c.stamp(c.zero_fill(df, ("a",)), "gold_process_ts").first()
    assert row["a"] == 0 and row["b"] is None and row["gold_process_ts"] is not None


def test_wire_names_round_trip():
    for table, names in contracts.WIRE_NAMES.items():
        assert len(set(names.values())) == len(names), table


# --- quality -----------------------------------------------------------------------------------


def test_filters(spark):
    df = frame(spark, [(1, None, None), (1, 2, None), (None, 2, 3), (1, None, 3)], "a int, b int, c int")
    assert q.require_all(df, ("a", "b")).count() == 1
    assert q.require_all(df, ()).count() == 4
    assert q.require_any(df, ("a",), ("b", "c")).count() == 2
    assert q.complete_pairs(df, ("a", "c")).collect() == [(1, 3)]


def test_split_rejects_partitions_the_rows(spark):
    df = frame(spark, [(1, None), (1, 2), (None, None)], "a int, b int")
    good, bad = q.split_rejects(df, {"no a": q.missing("a"), "no b": q.missing("b")})
    assert good.collect() == [(1, 2)]
    assert sorted(r[q.REASON] for r in bad.collect()) == ["no a", "no b"]
    assert good.count() + bad.count() == df.count()


def test_between_days(spark):
    days = frame(spark, [(dt.date(2024, 1, d),) for d in range(1, 6)], "date date")
    assert q.between_days(days, dt.date(2024, 1, 2), dt.date(2024, 1, 4)).count() == 3
    assert q.between_days(days, dt.date(2024, 1, 2)).count() == 5
    assert q.between_days(days).count() == 5


def test_checks(spark):
    df = frame(spark, [(1, None), (None, None)], "a int, b int")
    assert dict(q.check_not_null(df, ("a", "b")).collect()) == {"a": 1, "b": 2}
    assert q.check_row_count(df).collect() == [(2,)]


# --- dedup ---------------------------------------------------------------------------------------


def test_dedup_keeps_status_changes_and_picks_by_order(spark):
    df = frame(
        spark,
        [("a", 1, 20, "late"), ("a", 1, 10, "early"), ("a", 2, 30, "changed"), ("b", 1, 5, None)],
        "id string, ts int, ingest int, status string",
    )
    kept = dedup_events(df, ("id", "ts"), order=("ingest",))
    assert kept.columns == df.columns
    assert sorted(kept.collect()) == [("a", 1, 10, "early"), ("a", 2, 30, "changed"),
                                      ("b", 1, 5, None)]
    assert dedup_events(df.select("id"), ("id",)).count() == 2


def test_dedup_does_not_depend_on_partitioning(spark, sf):
    ev = spark.read.parquet(f"{sf}/events.parquet")
    one = dedup_events(ev.repartition(1), ("user_id", "event_type"))
    many = dedup_events(ev.repartition(13), ("user_id", "event_type"))
    assert same_rows(one, many)


def test_dedup_reduces_a_hot_key_before_the_shuffle(spark):
    """A third of the rows share a key; every task sends one of them on."""
    df = spark.range(0, 30_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("key"), "id"
    )
    kept = dedup_events(df, ("key",))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan
    assert kept.count() == 20_001
    assert kept.filter("key = -1").first()["id"] == 0


def test_stream_dedup_needs_a_horizon(spark, sf, folder):
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    stream = spark.readStream.schema(schema).parquet(folder)
    with pytest.raises(ValueError):
        dedup_events(stream, ("event_id",))


# --- rollups -------------------------------------------------------------------------------------


SPEC = RollupSpec(
    "s",
    ("k",),
    (
        rows("n"), distinct("d", "id"), mean("m", "x"), total("t", "x"), low("lo", "x"),
        high("hi", "x"), count_if("big", "x > 1"), latest("last", "ts"),
        total("gone", "absent", optional=True),
    ),
)


def measured(spark):
    t = [at(f"2024-01-0{d} 00:00:00") for d in range(1, 6)]
    return frame(
        spark,
        [("a", "p", 0.1, t[0]), ("a", "p", 0.2, t[1]), ("a", None, None, t[2]),
         ("b", None, None, None), ("a", "q", 1.5, t[0])],
        "k string, id string, x double, ts timestamp",
    )


def test_every_measure_and_null_rules(spark):
    found = {r["k"]: r.asDict() for r in rollup(measured(spark), SPEC).collect()}
    a, b = found["a"], found["b"]
    assert (a["n"], a["d"], a["t"], a["lo"], a["hi"], a["big"]) == (4, 2, 1.8, 0.1, 1.5, 1)
    assert a["m"] == 1.8 / 3 and a["last"].day == 3 and a["gone"] is None
    assert (b["n"], b["d"], b["t"], b["m"], b["big"], b["last"]) == (1, 0, None, None, 0, None)
    assert dict(rollup(measured(spark), SPEC).dtypes)["gone"] == "double"


def test_missing_required_measure_column_is_an_error(spark):
    spec = RollupSpec("s", ("k",), (mean("m", "absent"),))
    with pytest.raises(ValueError, match="absent"):
        rollup(measured(spark), spec)


def test_partials_merge_to_the_full_rollup(spark, sf):
    ev = spark.read.parquet(f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    spec = RollupSpec(
        "v", ("event_type",),
        (rows("n"), mean("m", "value"), total("t", "value"), low("lo", "value"),
         high("hi", "value"), count_if("c", "value > 5"), latest("l", "ts"),
         approx("users", "user_id")),
    )
    slices = [rollup_partial(ev.filter(F.col("event_id") % 3 == i), spec) for i in range(3)]
    merged = rollup_merge(slices[0].unionAll(slices[1]).unionAll(slices[2]), spec)
    exact = rollup(ev, spec.exact())
    assert merged.columns == spec.columns
    assert same_rows(merged.drop("users"), exact.drop("users"))
    wanted = dict(exact.select("event_type", "users").collect())
    for kind, users in merged.select("event_type", "users").collect():
        assert abs(users - wanted[kind]) <= 0.05 * wanted[kind] + 1


def test_totals_do_not_depend_on_task_order(spark):
    df = spark.range(0, 50_000, 1, 7).select(
        F.lit("a").alias("k"), (F.rand(3) * 1e6).alias("x")
    ).persist()
    spec = RollupSpec("s", ("k",), (total("t", "x"), mean("m", "x")))
    results = {tuple(rollup(df.repartition(n, F.rand(n)), spec).first()) for n in (1, 3, 8)}
    df.unpersist()
    assert len(results) == 1


def test_trip_defaults_and_incident_labels(spark):
    trips = frame(spark, [(dt.date(2024, 1, 1), 5, "t")], "event_date date, event_hour int, trip_id string")
    row = rollup(trips, gold.TRIPS_HOURLY).first()
    assert (row["status"], row["source"]) == ("desconhecido", "desconhecida")
    assert row["distinct_trips"] == 1 and row["distinct_drivers"] is None
    incidents = frame(
        spark,
        [(" Rio ", None, None, "1", dt.date(2024, 1, 1), 5), ("null", "x", "y", "2", dt.date(2024, 1, 1), 5)],
        "city string, type string, severity string, incident_id string, event_date date, event_hour int",
    )
    rolled = rollup(gold.clean_incidents(incidents), gold.INCIDENTS_HOURLY).collect()
    assert [(r["city"], r["type"], r["severity"]) for r in rolled] == [
        ("Rio", "nao_informado", "nao_informado")
    ]


# --- joins, spine, layout ------------------------------------------------------------------------


def test_with_region_keeps_unmatched(spark):
    seen = frame(spark, [("r1", 1), ("r9", 2), (None, 3)], "region_id string, n int")
    regions = frame(spark, [("X", "r1", "L", 1.0, 2.0)], contracts.REGIONS)
    joined = with_region(seen, regions)
    assert joined.columns == ["region_id", "n", "region_city", "region_label", "region_lat", "region_lon"]
    assert {r["n"]: r["region_label"] for r in joined.collect()} == {1: "L", 2: None, 3: None}


def test_missing_hours_per_key_and_overall(spark):
    df = frame(
        spark,
        [("a", at("2024-01-01 00:10:00")), ("a", at("2024-01-01 00:50:00")),
         ("a", at("2024-01-01 02:00:00")), ("b", at("2024-01-01 01:30:00")),
         ("b", at("2023-12-31 00:00:00")), ("c", None)],
        "k string, event_ts timestamp",
    )
    start, end = at("2024-01-01 00:00:00"), at("2024-01-01 03:59:00")
    assert hour_spine(spark, start, end).count() == 4
    per_key = missing_hours(df, start, end, ("k",))
    hours = sorted((r[0], r[1]) for r in per_key.select("k", F.hour("hour_ts")).collect())
    assert hours == [("a", 1), ("a", 3), ("b", 0), ("b", 2), ("b", 3),
                     ("c", 0), ("c", 1), ("c", 2), ("c", 3)]
    overall = missing_hours(df, start, end).select(F.hour("hour_ts")).collect()
    assert [r[0] for r in overall] == [3]


def files_per_hour(spark, path):
    files = spark.read.parquet(path).select("h", F.col("_metadata.file_path").alias("f")).distinct()
    return dict(files.groupBy("h").count().collect())


def test_layout_splits_a_hot_partition(spark, folder):
    """Hour 0 holds a third of the rows and more than one advisory size."""
    df = spark.range(0, 300_000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 8).alias("h"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "2MB")
    try:
        lay_out(df, ("h",)).write.partitionBy("h").parquet(folder + "/a")
    finally:
        spark.conf.set(key, before)
    files = files_per_hour(spark, folder + "/a")
    assert files[0] > 1
    one_file_each(df, ("h",)).write.partitionBy("h").parquet(folder + "/b")
    assert set(files_per_hour(spark, folder + "/b").values()) == {1}
    lay_out_stream(df, ("h",), files=3).write.partitionBy("h").parquet(folder + "/c")
    assert max(files_per_hour(spark, folder + "/c").values()) in (2, 3)
    for name in "abc":
        assert spark.read.parquet(f"{folder}/{name}").count() == 300_000
