import pytest
from pyspark.sql import functions as F

from mobility_lake.llm.histogram_sort import histogram_sort


def shards(docs, **options):
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 1
    return histogram_sort(docs.withColumn("bytes", size), F.col("text"), F.col("doc_id"), size, **options)


def check(rows, n):
    for shard in {r["shard"] for r in rows}:
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert all(0 <= r["shard"] < n for r in rows)


def test_bytes_are_near_equal_and_slots_gapless(spark):
    docs = spark.range(20000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") % 97).cast("int")).alias("text"))
    docs = docs.withColumn("text", F.concat(F.col("doc_id").cast("string"), "text"))
    rows = shards(docs, shards=7).collect()
    assert len(rows) == 20000
    check(rows, 7)
    sizes = [sum(r["bytes"] for r in rows if r["shard"] == s) for s in range(7)]
    assert max(sizes) - min(sizes) < 0.03 * sum(sizes) / 7


def test_a_hot_text_is_spread_and_small_groups_stay_whole(spark):
    docs = spark.range(9000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot text")).otherwise(F.concat(F.lit("text"), F.col("id") % 500)).alias("text"),
    )
    rows = shards(docs, shards=6).collect()
    check(rows, 6)
    sizes = [sum(r["bytes"] for r in rows if r["shard"] == s) for s in range(6)]
    assert max(sizes) - min(sizes) < 0.05 * sum(sizes) / 6
    homes = {}
    for r in rows:
        homes.setdefault(r["text"], set()).add(r["shard"])
    assert len(homes["hot text"]) > 1
    assert sum(len(h) > 1 for t, h in homes.items() if t != "hot text") <= 5


@pytest.mark.parametrize("n", [1, 3, 16])
def test_odd_rows(clashing, nothing, n):
    rows = shards(clashing, shards=n).collect()
    assert len(rows) == 16
    check(rows, n)
    assert shards(nothing, shards=n).collect() == []


def test_rows_equal_in_id_and_text_are_spread(spark):
    docs = spark.range(1200).select(
        F.when(F.col("id") < 400, F.lit(-1)).otherwise(F.col("id")).alias("doc_id"),
        F.when(F.col("id") < 400, F.lit("the same row again")).otherwise(F.concat(F.lit("text "), F.col("id") * 7)).alias("text"),
    )
    rows = shards(docs, shards=16).collect()
    check(rows, 16)
    sizes = [sum(r["bytes"] for r in rows if r["shard"] == s) for s in range(16)]
    assert max(sizes) - min(sizes) < 0.1 * sum(sizes) / 16
