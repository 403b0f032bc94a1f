import datetime as dt

from pyspark.sql import functions as F

from mobility_lake.plans import marts as m
from mobility_lake.plans import reports

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def gold_trips(spark):
    rows = [
        (D1, 0, "a", "s", 10, 4, 3, 2, 10.0, 40.0),
        (D1, 1, "a", "s", 5, 4, 3, 2, None, None),
        (D2, 0, "a", "s", 1, 0, 0, 0, 7.0, 7.0),
    ]
    return spark.createDataFrame(
        rows,
        "event_date date, event_hour int, status string, source string, records bigint, "
        "distinct_trips bigint, distinct_passengers bigint, distinct_drivers bigint, "
        "mean_price double, total_price double",
    )


def gold_weather(spark, *days):
    rows = [("X", "sol", d, 0, 1, t, t, t, 50.0, r) for d, t, r in days]
    return spark.createDataFrame(
        rows,
        "city string, condition string, event_date date, event_hour int, observations bigint, "
        "mean_temperature double, max_temperature double, min_temperature double, "
        "mean_humidity double, total_rain double",
    )


def gold_gps(spark):
    return spark.createDataFrame(
        [("X", D1, 0, 5, 2, 30.0, 1.0, 50.0)],
        "city string, event_date date, event_hour int, signals bigint, distinct_vehicles bigint, "
        "mean_speed double, min_speed double, max_speed double",
    )


def gold_traffic(spark):
    return spark.createDataFrame(
        [("X", "r", "l", D1, 0, 3, 2, 1.6, 1.7, 1.5, 1), ("X", "q", "l", D1, 1, 3, 2, 1.2, 1.7, 1.5, 1)],
        "city string, region_id string, label string, event_date date, event_hour int, "
        "observations bigint, observations_with_ratio bigint, mean_ratio double, max_ratio double, "
        "min_ratio double, errors bigint",
    )


def test_zero_fill_pulls_the_mean_of_means_down(spark):
    raw = {r["day"]: r for r in m.mobility_daily(gold_trips(spark)).collect()}
    staged = {r["day"]: r for r in m.mobility_daily(m.stage_trips(gold_trips(spark))).collect()}
    assert raw[1]["mean_price"] == 10.0 and staged[1]["mean_price"] == 5.0
    assert raw[1]["total_trips"] == 8 and raw[1]["total_revenue"] == 40.0


def test_exact_columns_count_people_once_per_day(spark):
    silver = spark.createDataFrame(
        [(D1, "t1", "p", "d", 10.0), (D1, "t1", "p", "d", None), (D1, "t2", "p", "d", 20.0)],
        "event_date date, trip_id string, passenger_id string, driver_id string, price double",
    )
    row = m.mobility_daily(gold_trips(spark), silver).filter("day = 1").first()
    assert (row["total_passengers"], row["total_passengers_exact"]) == (6, 1)
    assert (row["total_trips_exact"], row["mean_price_exact"]) == (2, 15.0)


def test_sketches_of_hours_unite_to_the_day(spark, sf, tmp_path):
    from entry_queries import views as v
    from mobility_lake.operators.rollup import RollupSpec, approx, rollup, rollup_merge, rollup_partial
    from mobility_lake.plans import gold
    from mobility_lake.sources.lake import lake_read, lake_rebuild

    trips = v.trips(spark, sf)
    path = str(tmp_path / "gold")
    lake_rebuild(rollup(trips, gold.TRIPS_SKETCHED), path, ("event_date",))
    daily = m.mobility_daily_from_sketches(lake_read(spark, path))
    plan = daily._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "trip_id" not in plan
    exact = {r["event_date"]: r for r in rollup(trips, gold.TRIPS_DAILY).collect()}
    for row in daily.collect():
        own = exact[row["event_date"]]
        assert row["total_records"] == own["records"]
        for name in ("trips", "passengers", "drivers"):
            assert abs(row[f"total_{name}"] - own[f"distinct_{name}"]) <= 0.06 * own[f"distinct_{name}"] + 1
    # One estimate, whether rows are rolled up at once or from partial rows.
    spec = RollupSpec("s", ("event_date",), (approx("people", "passenger_id"),))
    parts = rollup_partial(trips.filter("trip_id % 2 = 0"), spec).union(rollup_partial(trips.filter("trip_id % 2 = 1"), spec))
    assert sorted(map(tuple, rollup_merge(parts, spec).collect())) == sorted(map(tuple, rollup(trips, spec).collect()))


def test_date_column_can_be_the_processing_stamp(spark):
    stamped = gold_trips(spark).withColumn("gold_process_ts", F.lit("2024-03-01").cast("timestamp"))
    rows = m.trips_daily(stamped, "gold_process_ts").collect()
    assert [(r["date"], r["total_trips"], r["revenue"]) for r in rows] == [(dt.date(2024, 3, 1), 8, 47.0)]


def test_enriched_keeps_days_without_weather(spark):
    out = m.mobility_enriched(
        m.trips_daily(gold_trips(spark)),
        m.weather_daily(gold_weather(spark, (D1, 20.0, 0.0))),
        m.speed_daily(gold_gps(spark)),
    )
    rows = {r["date"]: r for r in out.collect()}
    assert (rows[D1]["mean_temperature"], rows[D1]["mean_speed"]) == (20.0, 30.0)
    assert (rows[D2]["mean_temperature"], rows[D2]["mean_speed"]) == (None, None)


def mart(spark):
    return m.daily_operations(
        gold_trips(spark), gold_weather(spark, (D1, 20.0, 3.0)), gold_gps(spark), gold_traffic(spark)
    )


def test_daily_operations_labels_and_ticket(spark):
    rows = {r["date"]: r for r in mart(spark).collect()}
    assert (rows[D1]["weather_status"], rows[D1]["traffic_status"]) == ("rain", "moderate")
    assert rows[D1]["mean_ticket"] == 5.0
    assert (rows[D2]["weather_status"], rows[D2]["traffic_status"]) == ("unknown", "unknown")
    assert rows[D2]["mean_ticket"] is None


def test_labels(spark):
    ratios = spark.createDataFrame([(1.19,), (1.2,), (1.49,), (1.5,), (None,)], "r double")
    assert [r[0] for r in ratios.select(m.traffic_label(F.col("r"))).collect()] == [
        "free", "moderate", "moderate", "heavy", "unknown",
    ]
    rain = spark.createDataFrame([(True, 0.0), (True, 0.1), (True, None), (None, None)], "w boolean, r double")
    assert [r[0] for r in rain.select(m.weather_label(F.col("w"), F.col("r"))).collect()] == [
        "dry", "rain", "dry", "unknown",
    ]


def test_reports(spark):
    table = mart(spark)
    assert [r["date"] for r in reports.ordered(table, desc=True).collect()] == [D2, D1]
    assert tuple(reports.date_bounds(table).first()) == (D1, D2)
    assert tuple(reports.kpis(table).first()) == (8, 47.0, 5.0, 20.0)
    assert reports.series(table, "mean_speed").count() == 2
    assert reports.series(table, "mean_speed", drop_null=True).count() == 1
    assert reports.preview(table, 1, by=("date",)).first()["date"] == D1
    assert reports.pairs(table, "mean_temperature", "total_trips").count() == 0
    assert reports.pairs(table, "total_trips", "revenue").count() == 2
    assert reports.detail_table(table).schema["date"].dataType.simpleString() == "date"


def test_congestion_by_city_and_hour(spark):
    staged = m.stage_traffic(gold_traffic(spark), gold_gps(spark))
    by_city = m.congestion(staged).first()
    assert (by_city["mean_congestion"], by_city["mean_speed"]) == (1.4, 30.0)
    assert m.congestion(staged, ("city", "event_hour")).count() == 2
    assert m.congestion(m.stage_traffic(gold_traffic(spark))).first()["mean_speed"] is None


def test_trip_duration_uses_first_terminal_status(spark):
    def t(second):
        return dt.datetime(2024, 1, 1, 0, 0, second, tzinfo=dt.timezone.utc)

    trips = spark.createDataFrame(
        [("a", "criada", t(0)), ("a", "concluida", t(30)), ("a", "concluida", t(50)), ("b", "criada", t(0))],
        "trip_id string, status string, event_ts timestamp",
    )
    assert m.trip_duration(trips, ("concluida",)).collect() == [(D1, 1, 30.0)]
