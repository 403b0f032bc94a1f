import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from mobility_lake.llm import kd_search as kd


def brute(rows, k, asks):
    usable = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for i, v in usable:
        if not asks(i):
            continue
        scores = sorted(((-sum(a * b for a, b in zip(v, w)), j) for j, w in usable if j != i and len(w) == len(v)))
        out |= {(i, rank + 1, j, -s) for rank, (s, j) in enumerate(scores[:k])}
    return out


def search(spark, rows, k, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, id int, vector int") if rows else spark.createDataFrame([], "vec_id long, embedding array<float>")
    return {tuple(r) for r in kd.top_k(df, F.col("vec_id") % 5 == 0, "vec_id", "embedding", k=k, **options).collect()}


@pytest.mark.parametrize("shard_rows", [10_000, 150])
def test_equals_brute_force(spark, shard_rows):
    random.seed(3)
    hot = [random.gauss(0, 1) for _ in range(6)]
    rows = [(i, hot if i % 3 == 0 else [float(np.float32(random.gauss(0, 1))) for _ in range(6)]) for i in range(700)]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    rows += [(1000, None), (1005, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (1010, [float("nan")] * 6), (1015, [float("inf")] * 6), (1020, []), (None, [1.0] * 6), (1025, [1.0, 2.0]), (1026, [0.5, 2.0])]
    got = search(spark, [(*r, 0, 0) for r in rows], 5, shard_rows=shard_rows)
    assert got == brute(rows, 5, lambda i: i % 5 == 0)


def test_few_rows(spark):
    assert search(spark, [(5, [1.0], 0, 0)], 5) == set()
    assert search(spark, [(5, [1.0], 0, 0), (6, [-0.001], 0, 0)], 5) == {(5, 1, 6, -256)}
    assert search(spark, [], 5) == set()


def test_tree_prunes_and_large_numbers_stay_exact():
    rng = np.random.default_rng(1)
    rows = rng.integers(-(1 << 27), 1 << 27, (1000, 8))
    tree = kd.Tree(np.arange(1000), rows)
    query = rows[:3]
    found = tree.search(np.arange(3), query, 4, np.full(3, -(1 << 62)))
    for i in range(3):
        exact = sorted(((int(sum(int(a) * int(b) for a, b in zip(query[i], r))), -j) for j, r in enumerate(rows) if j != i), reverse=True)
        assert found[i] == exact[:4]


@pytest.mark.parametrize("shard_rows", [10_000, 40])
def test_large_finite_components_take_part(spark, shard_rows):
    random.seed(8)
    rows = [(i, [float(np.float32(random.gauss(0, 1))) for _ in range(4)]) for i in range(200)]
    for i, large in ((5, 2.0**21), (6, -(2.0**22)), (10, 2.0**30), (11, -(2.0**35)), (15, float(np.float32(3e38))), (16, float(np.float32(-3e38)))):
        rows[i][1][i % 4] = large
    rows += [(201, rows[0][1]), (202, [2.0**21, 0.0, 0.0, 0.0])]
    got = search(spark, [(*r, 0, 0) for r in rows], 5, shard_rows=shard_rows)
    expected = brute(rows, 5, lambda i: i % 5 == 0)
    assert {r[0] for r in expected} >= {5, 10, 15}
    assert got == {(q, rank, i, s if -(1 << 63) <= s < 1 << 63 else None) for q, rank, i, s in expected}


def test_bytes_are_in_the_order_of_numbers():
    numbers = sorted({s * x for x in (0, 1, 2, 127, 128, 255, 256, 257, 65535, 65536, 10**40, 10**76) for s in (1, -1)})
    assert sorted(numbers, key=kd.in_order) == numbers
