"""Rebuilds in one step: failures, readers, leftovers, writers that meet."""

import datetime as dt
import os
import subprocess
import sys
import textwrap

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from mobility_lake.sources import versions
from mobility_lake.sources.lake import (
    lake_read,
    lake_rebuild,
    lake_replace_partitions,
    lake_stream,
    read_partitions,
)

NO_TIME = dt.timedelta(0)


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "n int")


def found(df):
    return sorted(r["n"] for r in df.collect())


def test_a_rebuild_that_fails_leaves_the_old_table(spark, path):
    lake_rebuild(numbers(spark, 1, 2), path)
    broken = spark.range(0, 100, 1, 4).select(
        F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("int").alias("n")
    )
    with pytest.raises(PySparkException):
        lake_rebuild(broken, path)
    assert found(lake_read(spark, path)) == [1, 2]
    assert any(name.startswith("_data") for name in versions.remove_old(spark, path, NO_TIME))
    assert found(lake_read(spark, path)) == [1, 2]


def test_a_killed_rebuild_leaves_the_old_table(spark, path):
    """The writer's process ends after its files, before its pointer."""
    lake_rebuild(numbers(spark, 1, 2), path)
    script = f"""
        import os, sys
        sys.path.insert(0, {os.getcwd()!r})
        from mobility_lake import session
        from mobility_lake.sources import versions
        from mobility_lake.sources.lake import lake_rebuild
        spark = session.build("killed", spark__master="local[1]", spark__ui__enabled="false")
        versions.commit = lambda *a: os.kill(os.getpid(), 9)
        lake_rebuild(spark.range(5).selectExpr("cast(id as int) as n"), {path!r})
    """
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(script)], capture_output=True, timeout=300)
    assert done.returncode == -9
    assert len(versions.names_in(spark, f"{path}/_data")) == 2
    assert found(lake_read(spark, path)) == [1, 2]
    lake_rebuild(numbers(spark, 3), path)
    assert found(lake_read(spark, path)) == [3]


def test_a_reader_sees_one_version(spark, path):
    lake_rebuild(numbers(spark, 1, 2), path)
    before = lake_read(spark, path)
    lake_rebuild(numbers(spark, 3), path)
    assert found(before) == [1, 2] and found(lake_read(spark, path)) == [3]


def test_an_unfinished_pointer_does_not_count(spark, path, monkeypatch):
    monkeypatch.setattr(versions, "PATIENCE_S", 0.0)
    lake_rebuild(numbers(spark, 1), path)
    with open(f"{path}/_versions/{1:012d}", "w") as file:
        file.write('{"folder": "v-')
    assert found(lake_read(spark, path)) == [1]
    lake_rebuild(numbers(spark, 2), path)
    assert found(lake_read(spark, path)) == [2]
    assert sorted(versions.names_in(spark, f"{path}/_versions") - {f".{n:012d}.crc" for n in range(3)})[-1] == f"{2:012d}"


def test_writers_that_meet_start_over(spark, path):
    calls = []

    def add(name):
        def change(state):
            if not calls:  # another writer comes first
                calls.append(name)
                versions.commit(spark, path, lambda s: {"runs": [*(s or {"runs": []})["runs"], {"name": "other"}]})
            return {"runs": [*(state or {"runs": []})["runs"], {"name": name}]}

        return change

    versions.commit(spark, path, add("own"))
    assert versions.state(spark, path)["runs"] == [{"name": "other"}, {"name": "own"}]


def test_old_versions_go_by_age(spark, path):
    numbers(spark, 0).write.parquet(path)  # from before the table had versions
    assert found(lake_read(spark, path)) == [0]
    for n in (1, 2, 3):
        lake_rebuild(numbers(spark, n), path)
    assert versions.remove_old(spark, path) == []
    gone = versions.remove_old(spark, path, NO_TIME)
    assert sum(name.startswith("_data") for name in gone) == 2 and any(name.startswith("part-") for name in gone)
    assert found(lake_read(spark, path)) == [3]
    assert versions.remove_old(spark, path, NO_TIME) == []
    assert versions.remove_old(spark, path + "-none", NO_TIME) == []


def test_pointers_stay_few(spark, path):
    for n in range(30):
        versions.commit(spark, path, lambda state, n=n: {"runs": [{"name": f"r{n}"}]})
    assert len({n for n in versions.names_in(spark, f"{path}/_versions") if n.isdigit()}) == versions.KEPT + 1
    found = versions.state(spark, path)
    assert found["runs"] == [{"name": "r29"}] and len(found["retired"]) == 29


def test_writers_and_streams_follow_the_newest_version(spark, path, tmp_path):
    rows = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 2))], "n int, day date")
    lake_rebuild(rows, path, ("day",))
    lake_rebuild(rows.withColumn("n", F.col("n") * 10), path, ("day",))
    lake_replace_partitions(rows.filter("n = 2"), path, ("day",))
    assert found(lake_read(spark, path)) == [2, 10]
    part = read_partitions(spark, path, ("day",), [(dt.date(2024, 1, 1),), (dt.date(2024, 1, 3),)], rows.schema)
    assert found(part) == [10]
    query = (
        lake_stream(spark, path, rows.schema).writeStream.format("parquet").trigger(availableNow=True)
        .option("checkpointLocation", str(tmp_path / "ck")).start(str(tmp_path / "out"))
    )
    query.awaitTermination()
    assert found(spark.read.parquet(str(tmp_path / "out"))) == [2, 10]
