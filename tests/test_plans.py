"""What the physical plans must and must not hold."""

import re

import pytest
from helpers import at
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401  (registers the queries)
from entry_queries.registry import QUERIES
from entry_queries import views as v
from mobility_lake import contracts
from mobility_lake.operators.dedup import dedup_events
from mobility_lake.operators.rollup import rollup
from mobility_lake.plans import gold
from mobility_lake.plans.bronze import BRONZE
from mobility_lake.plans.silver import MARK
from mobility_lake.operators.quality import accepted, between_days

WRITING = {
    "scan_partition_prune", "rebuild_roundtrip", "file_inventory", "refresh_touched",
    "partials_merge", "window_hourly", "dedup_stream",
}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING))
def test_no_pairing_joins_no_python_and_no_ranked_groups(spark, sf, name):
    plan = plan_of(QUERIES[name](spark, sf))
    for operator in ("CartesianProduct", "NestedLoop", "Python", "Pandas", "Arrow", "Window"):
        assert operator not in plan, operator


def test_rollup_reads_only_its_columns(spark, sf):
    plan = plan_of(rollup(v.trips(spark, sf), gold.TRIPS_HOURLY))
    schema = re.search(r"ReadSchema: struct<(.*?)>", plan).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {
        "event_id", "ts", "user_id", "event_type", "value", "props",
    }
    plan = plan_of(rollup(v.gps(spark, sf), gold.GPS_HOURLY))
    assert "event_type" not in plan and "r_name" not in plan


def test_exact_distinct_spreads_a_hot_group(spark, sf):
    """The first shuffle is on the group and the id, so one hour is not one task."""
    plan = plan_of(rollup(v.gps(spark, sf), gold.GPS_HOURLY))
    shuffles = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)
    assert len(shuffles) == 2
    assert "vehicle_id" in shuffles[1] and "vehicle_id" not in shuffles[0]
    assert plan.count("partial_") > 0


def test_plain_measures_need_one_shuffle(spark, sf):
    plan = plan_of(rollup(v.traffic(spark, sf), gold.TRAFFIC_HOURLY))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1


def test_dedup_needs_one_shuffle(spark, sf):
    plan = plan_of(dedup_events(v.duplicated(spark, sf), ("event_id",)))
    assert len(re.findall(r"Exchange", plan)) == 1 and "partial_min" in plan


def test_day_range_reaches_the_scan(spark, sf):
    import datetime as dt

    df = spark.read.parquet(f"{sf}/orders.parquet")
    plan = plan_of(between_days(df, dt.date(1995, 1, 1), dt.date(1995, 2, 1), "o_orderdate"))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan


@pytest.mark.parametrize("feed", ["trips", "traffic"])
def test_silver_parses_each_record_once(spark, sf, folder, feed):
    BRONZE[feed](v.RECORDS[feed](spark, sf)).write.parquet(folder + "/bronze")
    bronze = spark.read.schema(contracts.BRONZE[feed]).parquet(folder + "/bronze")
    plan = plan_of(accepted(MARK[feed](bronze)))
    assert plan.count("Generate json_tuple(") == 1
    assert "get_json_object" not in plan and "from_json" not in plan


def test_hot_group_gives_right_counts(spark):
    """A third of two million signals come from one city and hour."""
    n = 2_000_000
    hot = F.col("id") % 3 == 0
    signals = spark.range(0, n, 1, 8).select(
        F.when(hot, F.lit("hot")).otherwise((F.col("id") % 50).cast("string")).alias("city"),
        (F.col("id") % 700_001).cast("string").alias("vehicle_id"),
        F.lit(1.25).alias("speed_kmh"),
        F.lit(at("2024-01-01 00:00:00")).alias("event_ts"),
        F.lit(None).cast("date").alias("event_date"),
        F.lit(0).alias("event_hour"),
    )
    row = rollup(signals, gold.GPS_HOURLY).filter("city = 'hot'").first()
    ids = {i % 700_001 for i in range(0, n, 3)}
    assert (row["signals"], row["distinct_vehicles"]) == (len(range(0, n, 3)), len(ids))
    assert row["mean_speed"] == 1.25
