"""Periodic runs against a plain search over all periods."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from mobility_lake.llm import queries
from mobility_lake.llm import run_detection as rd


def plain_runs(words, least=6, times=4):
    """(start, length, period) of all runs."""
    out, n = [], len(words)
    for q in range(1, n // times + 1):
        start = 0
        while start + q < n:
            if words[start] != words[start + q]:
                start += 1
                continue
            end = start
            while end + q < n and words[end] == words[end + q]:
                end += 1
            own = words[start : end + q]
            smaller = any(all(own[i] == own[i + p] for i in range(len(own) - p)) for p in range(1, q))
            if len(own) >= max(least, times * q) and not smaller:
                out.append((start, len(own), q))
            start = end
    return sorted(out)


def plain_collapsed(words, runs):
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def strange(made):
    """Words of few kinds with cycles put in, some of one letter but for an end."""
    kinds = made.choice([1, 2, 2, 3, 5, 40])
    words = [f"w{made.randrange(kinds)}" for _ in range(made.randint(0, 260))]
    for _ in range(made.randint(0, 3) if words else 0):
        at, period = made.randrange(len(words)), made.randint(1, made.choice([3, 10, 50]))
        cycle = [f"w{made.randrange(kinds)}" for _ in range(period)]
        if made.random() < 0.5:
            cycle = ["w0"] * (period - 1) + ["w1"]
        put = [cycle[i % period] for i in range(made.randint(1, 7 * period))]
        words[at : at + made.choice([0, len(put)])] = put
    return words


def test_all_runs_of_strange_texts(monkeypatch):
    made = random.Random(11)
    for cells in (1 << 20, 64):  # few blocks to a transform
        monkeypatch.setattr(rd, "CELLS", cells)
        for _ in range(40):
            docs = [strange(made) for _ in range(6)]
            found = rd._of_batch(pa.array([" ".join(d) for d in docs]), 6, 4)
            for words, runs, collapsed in zip(docs, found["runs"].to_pylist(), found["collapsed"].to_pylist()):
                expected = plain_runs(words)
                assert [(r["start"], r["length"], r["period"]) for r in runs] == expected
                assert collapsed.decode() == plain_collapsed(words, expected)


def test_convolution_is_exact():
    made = np.random.default_rng(3)
    for block in (2, 16, 256):
        codes = made.integers(0, 900, 8 * block)
        starts = np.array([0, block, 3 * block, 5 * block])
        found = rd.mismatches(codes, starts, block)
        for row, start in zip(found, starts):
            for shift in range(block, 2 * block):
                apart = codes[start : start + block] - codes[start + shift : start + shift + block]
                assert row[shift - block] == (apart**2).sum()


def test_long_texts_and_long_periods():
    made = random.Random(4)
    cycle = [str(made.random()) for _ in range(5000)]
    texts = ["a " * 200_000, " ".join(["x"] + cycle * 5), " ".join((["a"] * 999 + ["b"]) * 40)]
    found = rd._of_batch(pa.array(texts), 6, 4)["runs"].to_pylist()
    assert [[tuple(r.values()) for r in own] for own in found[:2]] == [[(0, 200_000, 1)], [(1, 25_000, 5000)]]
    assert (0, 40_000, 1000) in [tuple(r.values()) for r in found[2]] and len(found[2]) == 41


def test_strongest_is_exact_and_prefers_the_first():
    assert rd.strongest([]) is None
    assert rd.strongest([(9, 12, 3), (5, 8, 2), (5, 4, 1)]) == (5, 4, 1)
    big = 10**9
    assert rd.strongest([(0, 4 * big + 1, big), (7, 4 * big + 5, big + 1)]) == (0, 4 * big + 1, big)


def test_odd_rows(spark, clashing, nothing):
    docs = clashing.withColumnsRenamed({"kept": "runs"})
    found = {(r["doc_id"], r["text"]): r for r in rd.find_runs(docs).collect()}
    assert len(rd.find_runs(docs).collect()) == docs.count() and rd.find_runs(nothing).collect() == []
    for (_, text), row in found.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        assert row["n_words"] == len(words) and row["piece"] == 7
        runs = [(r["start"], r["length"], r["period"]) for r in row["runs"]]
        if len(words) < 3000:
            assert runs == plain_runs(words)
        assert row["collapsed"] == plain_collapsed(words, runs)
    with pytest.raises(ValueError):
        rd.find_runs(docs, times=3)


def test_query_equals_plain_search(spark, sf):
    given = duckdb.sql(f"select doc_id, text from '{sf}/documents.parquet'").fetchall()
    rows = {r["doc_id"]: r.asDict() for r in queries.QUERIES["op11_run_detection"](spark, sf).collect()}
    assert len(rows) == len(given)
    planted = 0
    for doc_id, text in given:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n, hashed = len(words), zlib.crc32(str(doc_id).encode())
        if hashed % 10 == 0 and n:
            at = hashed // 10 % n
            period = 1 + (n - at) // (3 + hashed // 10 % 8)
            words = [words[i] if i < at else words[at + (i - at) % period] for i in range(n)]
        if n > 1500:
            continue  # the plain search is quadratic
        runs = plain_runs(words)
        planted += len(runs)
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
        spelled = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
        assert rows[doc_id] == {
            "doc_id": doc_id, "n_runs": len(runs), "start": best[0], "length": best[1], "period": best[2],
            "exponent_milli": best[0] if best[0] is None else 1000 * best[1] // best[2],
            "runs_sha256": hashlib.sha256(spelled.encode()).hexdigest(),
            "collapsed_sha256": hashlib.sha256(plain_collapsed(words, runs).encode()).hexdigest(),
        }
    assert planted > 10
