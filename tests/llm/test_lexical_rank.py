"""Ranked search against scores of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from mobility_lake.llm import lexical_rank as lr
from mobility_lake.llm import queries

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain_terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain_rank(docs, items, k):
    """(item_id, rank, doc_id, score) of all items."""
    counted = [(d, Counter(plain_terms(t))) for d, t in docs]
    sizes = [sum(c.values()) for _, c in counted]
    count, length = sum(n > 0 for n in sizes), sum(sizes)
    held = Counter(t for _, c in counted for t in c)
    out = []
    for item_id, text in items:
        found = []
        for (doc_id, own), n in zip(counted, sizes):
            score = 0
            for term, times in Counter(plain_terms(text)).items():
                if own[term]:
                    w = math.floor(1000 * math.log((2 * count + 2) / (2 * held[term] + 1)))
                    m = 75 + 25 * n * count // length
                    score += times * w * (10**9 * own[term] // (1000 * own[term] + 12 * m))
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0))
        out += [
            (item_id, i + 1, None if none else doc, -score) for i, (score, none, doc) in enumerate(sorted(found)[:k])
        ]
    return sorted(out, key=lambda r: (r[0], r[1]))


def ranked(spark, docs, items, k=20, **options):
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame(items, "item_id long, text string")
    return sorted(map(tuple, lr.rank(docs, items, k, **options).collect()), key=lambda r: (r[0], r[1]))


def test_terms():
    for text in ("Ab-c1 É_x\u0000y", "Straße ÅÄ 漢字,テ", "İİ", "", None, "[]{}`@/:"):
        assert [t.decode() for t in lr.terms(text)] == plain_terms(text)


def random_corpus(seed, rows):
    made = random.Random(seed)
    words = [f"t{int(made.paretovariate(0.6)) % 300}" for _ in range(4000)]
    docs = [(i, " ".join(made.choices(words, k=made.randint(0, 40)))) for i in range(rows)]
    docs += [(made.randrange(rows), docs[0][1]) for _ in range(30)] + [(None, docs[1][1]), (None, None), (7, "")]
    items = [(i, " ".join(made.choices(words, k=made.randint(1, 25)))) for i in range(8)]
    return docs, [*items, (100, None), (101, "unheard of"), (102, " ".join(words[:3] * 4))]


@pytest.mark.parametrize("k", [1, 20])
def test_equals_scores_of_all_documents(spark, k, monkeypatch):
    docs, items = random_corpus(5, 500)
    monkeypatch.setattr(lr, "STEP", 2)
    assert ranked(spark, docs, items, k) == plain_rank(docs, items, k)


def test_blocks_of_queries(spark):
    docs, items = random_corpus(6, 200)
    assert ranked(spark, docs, items, 5, block_bytes=200) == plain_rank(docs, items, 5)


def test_empty_tables_and_extra_columns(spark, clashing):
    items = spark.createDataFrame([(1, "word1 word2 passage4", 3)], "item_id long, text string, score int")
    assert lr.rank(clashing.filter("1 = 0"), items).collect() == []
    assert lr.rank(clashing, items.filter("1 = 0")).collect() == []
    found = sorted(map(tuple, lr.rank(clashing, items, 20).collect()), key=lambda r: r[1])
    assert found == plain_rank([(r["doc_id"], r["text"]) for r in clashing.collect()], [(1, "word1 word2 passage4")], 20)


def test_it_stops_early_and_keeps_ties():
    made = np.random.default_rng(8)
    documents, term_count = 20_000, 6
    doc = np.repeat(np.arange(documents), term_count)
    term = np.tile(np.arange(term_count), documents)
    impact = (1 + made.pareto(1.0, len(doc)) * 1000).astype(np.int64)
    shard = lr.Shard(np.arange(documents)[::-1].copy(), doc, term, impact, term_count)
    looked = []
    plain = shard._look_up
    shard._look_up = lambda docs: looked.append(len(docs)) or plain(docs)
    query, times = np.arange(term_count), np.array([1, 1, 2, 1, 1, 3])
    docs, scores = shard.best(query, times, 20, 0)
    total = (impact.reshape(documents, term_count) * times).sum(axis=1)
    order = np.lexsort((shard.ids, -total))[:20]
    assert docs.tolist() == order.tolist() and scores.tolist() == total[order].tolist()
    assert sum(looked) < documents / 4
    # A floor stops sooner and loses nothing at or above it; a second search finds the shard clean.
    looked.clear()
    again, _ = shard.best(query, times, 20, int(scores[4]))
    assert again.tolist()[:5] == order[:5].tolist() and not shard.met.any() and not shard.seen.any()
    # All scores equal: the ids decide, and every tie is looked at.
    flat = lr.Shard(np.arange(300)[::-1].copy(), np.arange(300), np.zeros(300, np.int64), np.full(300, 5), 1)
    assert flat.best(np.array([0]), np.array([1]), 3, 0)[0].tolist() == [299, 298, 297]


def test_query_equals_scores_of_all_documents(spark, folder, documents):
    documents.write.parquet(folder + "/documents.parquet")
    items = [(1, "quick dog word7"), (2, "passage9 passage100 éàü1"), (3, "löng")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(folder + "/benchmark.parquet")
    found = queries.QUERIES["op13_best_position_search"](spark, folder).collect()
    given = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert sorted(map(tuple, found), key=lambda r: (r[0], r[1])) == plain_rank(given, items, 20)
