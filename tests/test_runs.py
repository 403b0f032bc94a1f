"""Tables of runs: levels, retries, the key index and partial rows on top of them."""

import datetime as dt
import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from mobility_lake.operators.rollup import RollupSpec, distinct, distinct_ids, mean, rollup, rollup_partial, rows, total
from mobility_lake.sources import runs, versions
from mobility_lake.streaming import incremental, key_index

KEYS = ("id",)


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def ids(spark, values):
    return spark.createDataFrame([(v,) for v in values], "id string")


def test_runs_stay_few_over_a_thousand_batches(spark, path, monkeypatch):
    """Without data, and with the pointer in memory: what is listed is what a reader opens."""
    held = {}

    def commit(spark, path, change):
        held["state"] = change(held.get("state"))
        return held["state"]

    monkeypatch.setattr(versions, "commit", commit)
    monkeypatch.setattr(versions, "state", lambda spark, path: held.get("state"))
    most = 0
    for batch in range(1000):
        runs.merge(spark, path, lambda chosen, folder: {"n": sum(r.notes["n"] for r in chosen)}, before=batch)
        runs.add(spark, path, batch, lambda folder: {"n": 1})
        live = runs.live(spark, path)
        most = max(most, len(live))
    assert sum(run.notes["n"] for run in live) == 1000
    assert most <= 4 * runs.FAN and max(run.level for run in live) == 3


def test_a_retried_batch_replaces_its_run_and_a_merged_one_adds_nothing(spark, path):
    for batch in (0, 1, 1):
        assert runs.add(spark, path, batch, lambda folder: {})
    assert [(r.batch, r.level) for r in runs.live(spark, path)] == [(0, 0), (1, 0)]
    assert runs.merge(spark, path, lambda chosen, folder: {}, fan=2) == 1
    assert not runs.add(spark, path, 1, lambda folder: pytest.fail("written again"))
    assert runs.add(spark, path, 2, lambda folder: {})
    assert [(r.batch, r.level) for r in runs.live(spark, path)] == [(1, 1), (2, 0)]


def test_a_merge_gives_way_to_a_batch_written_anew(spark, path):
    for batch in (0, 1):
        runs.add(spark, path, batch, lambda folder: {})

    def write(chosen, folder):
        runs.add(spark, path, 1, lambda folder: {"again": True})
        return {}

    assert runs.merge(spark, path, write, fan=2) == 0
    assert [r.notes for r in runs.live(spark, path)] == [{}, {"again": True}]


def test_the_index_finds_all_keys_and_reads_few_files(spark, path):
    seen, made = set(), random.Random(7)
    files = []
    for batch in range(9):
        new = [f"k{batch}-{i}" for i in range(40)]
        old = made.sample(sorted(seen), min(len(seen), 3 if batch % 2 else 0))
        rows_in = ids(spark, [*new, *old])
        key_index.merge(spark, KEYS, path, before=batch, fan=2)
        found = key_index.known(rows_in, KEYS, path, batch)
        known = set() if found is None else {r["id"] for r in found.collect()}
        assert known & {*new, *old} == set(old)
        live = runs.live(spark, path)
        files.append(len(live) + (0 if found is None else len(found.inputFiles())))
        key_index.add(ids(spark, new), KEYS, path, batch)
        seen |= set(new)
    assert max(files) <= 8 and len(runs.live(spark, path)) <= 4
    # The batch itself does not count as known, also when its run is there already.
    found = key_index.known(ids(spark, ["k8-1"]), KEYS, path, 8)
    assert found is None or found.filter("id = 'k8-1'").isEmpty()
    assert key_index.known(ids(spark, ["k8-1"]), KEYS, path, 9).filter("id = 'k8-1'").count() == 1


def test_parts_and_filters_of_a_larger_run(spark, path, monkeypatch):
    monkeypatch.setattr(key_index, "PART_KEYS", 1000)
    rows_in = spark.range(10_000).select(F.col("id").cast("string").alias("id"))
    key_index.rebuild(rows_in.union(rows_in), KEYS, path)
    [run] = runs.live(spark, path)
    assert run.notes == {"keys": 10_000, "bits": 18, "parts": 4}
    others = spark.range(10_000, 30_000).select(F.col("id").cast("string").alias("id"))
    assert key_index.candidates(others, KEYS, path, [run]).count() < 1000  # about 1.4 %
    assert key_index.candidates(rows_in, KEYS, path, [run]).count() == 10_000
    one = key_index.known(ids(spark, ["77", "x"]), KEYS, path, 0)
    assert one.filter("id = '77'").count() == 1 and one.count() < 2000
    key_index.rebuild(ids(spark, []), KEYS, path)
    assert key_index.known(ids(spark, ["77"]), KEYS, path, 0) is None


PARTIAL = RollupSpec("p", ("day", "kind"), (rows("n"), mean("m", "x"), total("t", "x"), distinct("d", "who")))


def test_compaction_shrinks_what_is_read(spark, path):
    def part(batch):
        return spark.range(200).select(
            F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 5).cast("int")).alias("day"),
            (F.col("id") % 3).alias("kind"), (F.col("id") * 0.37 + batch).alias("x"),
            F.when(F.col("id") % 7 > 0, F.col("id") % (20 + batch)).alias("who"),
        )

    def add(batch):
        write = incremental._write_partials
        runs.add(spark, path, batch, lambda folder: write(rollup_partial(part(batch), PARTIAL), distinct_ids(part(batch), PARTIAL), PARTIAL, folder))

    def check(batches):
        full = part(0)
        for batch in range(1, batches):
            full = full.union(part(batch))
        merged = incremental.merge_partials(spark, PARTIAL, path)
        assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, rollup(full, PARTIAL).collect()))
        return len(merged.inputFiles())

    for batch in range(6):
        add(batch)
    before = check(6)
    assert before >= 6 and incremental.compact_partials(spark, PARTIAL, path, fan=4) == 1
    after = check(6)
    assert after < before / 3
    compacted = set(incremental.merge_partials(spark, PARTIAL, path).inputFiles())
    [run] = runs.live(spark, path)
    assert all(run.name in name for name in compacted)
    add(5)  # retried: part of the compacted run
    assert check(6) == after
    add(6)
    check(7)
    assert incremental.compact_partials(spark, PARTIAL, path, fan=4) == 0
    versions.remove_old(spark, path, dt.timedelta(0))
    check(7)
    assert len(glob.glob(os.path.join(path, "_data", "*"))) == 2
