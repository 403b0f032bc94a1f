import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from mobility_lake.llm import ngram_join as nj
from mobility_lake.llm.components import components


def corpus(seed, groups=12, hot=40):
    random.seed(seed)
    word = lambda: "".join(random.choices("abcdefgh", k=3))
    passage = [word() for _ in range(30)]
    texts = []
    for g in range(groups):
        base = [word() for _ in range(random.randint(3, 90))]
        if g % 3 == 0:
            base[5:5] = passage
        for _ in range(hot if g == 0 else random.randint(1, 6)):
            copy = list(base)
            for _ in range(random.randint(0, 4)):
                copy[random.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    random.shuffle(texts)
    return texts


def run(docs, **options):
    return sorted(tuple(r) for r in nj.near_duplicates(docs, **options).collect())


@pytest.mark.parametrize("unit_docs,screen_docs", [(2048, 8192), (6, 8192), (6, 5)])
def test_equals_all_pairs(spark, unit_docs, screen_docs):
    texts = corpus(unit_docs + screen_docs)
    ids = [3 * i + 1 for i in range(len(texts))]
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").repartition(5)
    assert run(docs, unit_docs=unit_docs, screen_docs=screen_docs) == brute.near_components(ids, texts)


def test_odd_rows(documents, clashing, nothing):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect() if r["doc_id"] is not None]
    expected = brute.near_components(*zip(*rows))
    assert run(clashing) == expected
    assert {c for i, _, c in expected if i in (2, 3, 14)} == {2} and (8, 1, 7) in expected
    assert run(nothing) == []


def test_tree_finds_exactly_the_linked_sets():
    rng = np.random.default_rng(4)
    sets = []
    for _ in range(60):
        base = rng.choice(40, rng.integers(1, 30), replace=False)
        sets.append(np.sort(base).astype(np.uint64))
    sets += [s[:-1] for s in sets[:20] if len(s) > 1] + [sets[0]]
    tree = nj.PrefixTree(sets)
    for i, probe in enumerate(sets):
        linked = [j for j, s in enumerate(sets) if 100 * len(np.intersect1d(s, probe)) >= 75 * len(np.union1d(s, probe))]
        assert sorted(tree.probe(probe, 75)) == linked, i


def test_components_of_a_long_chain(spark):
    links = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).union(spark.sql("select 1000L, 999L"))
    found = {r["node"]: r["component"] for r in components(links).collect()}
    assert found == {**{i: 0 for i in range(201)}, 999: 999, 1000: 999}
    assert components(links.filter("a < 0")).collect() == []


def test_screen_keeps_every_linked_pair_connected():
    rng = np.random.default_rng(7)
    sets = []
    for _ in range(40):
        base = rng.integers(0, 1 << 60, rng.integers(1, 400)).astype(np.uint64)
        sets.append(np.unique(base))
        for _ in range(3):
            keep = rng.random(len(base)) > 0.1
            sets.append(np.unique(np.concatenate([base[keep], rng.integers(0, 1 << 60, 3).astype(np.uint64)])))
    sizes = np.array([len(s) for s in sets])
    edges = nj.screened(list(range(len(sets))), sizes, [nj.signature(s) for s in sets], 75)
    top = list(range(len(sets)))
    for a, b in edges:
        top = [min(top[a], top[b]) if t in (top[a], top[b]) else t for t in top]
    for i in range(len(sets)):
        for j in range(i):
            if 100 * len(np.intersect1d(sets[i], sets[j])) >= 75 * len(np.union1d(sets[i], sets[j])):
                assert top[i] == top[j]
    assert len(edges) < len(sets) - 20


def test_repeated_ids_with_differing_texts_hide_no_candidate(spark):
    random.seed(21)
    word = lambda: "".join(random.choices("abcdefgh", k=4))
    base = [word() for _ in range(80)]
    small, text = " ".join(word() for _ in range(10)), " ".join(base)
    near = " ".join(base[:70] + [word() for _ in range(5)])
    # Of id 5 the smaller set counts; its other text is that of 7, and 9 is near it.
    rows = [(5, small), (5, text), (7, text), (9, near)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = {(i, c) for i, _, c in run(docs)}
    assert found == {(5, 5), (7, 7), (9, 7)}


def test_partners_two_widths_apart_below_half(spark):
    long = [f"w{i}" for i in range(154)]
    docs = spark.createDataFrame([(1, " ".join(long)), (2, " ".join(long[:67])), (3, "some other words in a row here")], "doc_id long, text string")
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in nj.near_duplicates(docs, words=5, percent=40).collect()}
    assert found == {1: (150, 1), 2: (63, 1), 3: (3, 3)}


def test_prefix_shingles_send_set_digest_and_size_once_per_run():
    import pyarrow as pa

    texts = corpus(7)
    batch = pa.record_batch([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["id", "text"])
    run_of, _ = nj._prefixes(5, 75, np.zeros(1 << nj.COUNTERS, np.uint8), 4)
    packed = list(run_of(iter([batch])))
    held = {n: [b for x in packed for b in x.column(n).to_pylist()] for n in nj.PACKED}
    sent = sum(len(b) for parts in held.values() for b in parts)
    key, ids, sizes, places = nj.unpacked(held)
    assert len(key) and sent < 16 * len(key)  # 24 bytes a shingle before
    # Each set sent has all places of its prefix, with its own size.
    for digest in np.unique(ids):
        own = ids == digest
        size = int(sizes[own][0])
        assert (sizes[own] == size).all()
        assert sorted(places[own].tolist()) == list(range(size - -(-75 * size // 100) + 1))
