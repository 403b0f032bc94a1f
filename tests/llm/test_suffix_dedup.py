import collections
import random
import re

import brute
import numpy as np
import pytest

from mobility_lake.llm import suffix_dedup as sd


def corpus(seed, length):
    random.seed(seed)
    letters = lambda n: "".join(random.choices("abé ", k=n))
    passages = [letters(random.randint(length - 3, 3 * length)) for _ in range(6)]
    texts = [None, "", letters(length - 1), "a" * (4 * length), "ab" * (2 * length)]
    for _ in range(40):
        texts.append("".join(random.choice([letters(random.randint(0, 2 * length)), random.choice(passages)]) for _ in range(4)))
    for _ in range(12):
        base = passages[0] + passages[1]
        cut = random.randrange(len(base))
        texts.append(letters(random.randint(0, 5)) + base[cut // 4 : cut] + letters(random.randint(0, 5)))
    return texts + texts[:8] + [texts[9]] * 5


def found(docs, length, **options):
    rows = sd.remove_repeats(docs, length=length, **options).collect()
    return sorted(((r["doc_id"], [(s["start"], s["stop"]) for s in r["spans"]], bytes(r["kept"])) for r in rows), key=repr)


@pytest.mark.parametrize("length,most", [(20, 50_000), (20, 2), (33, 50_000)])
def test_equals_brute_force(spark, length, most):
    texts = corpus(length + most, length)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    expected = sorted(((i, *e) for i, e in enumerate(brute.without_repeats(texts, length))), key=repr)
    assert found(docs, length, most=most) == expected


def test_chunks_do_not_show(monkeypatch):
    random.seed(9)
    text = "".join(random.choices("abc", k=5000)).encode() + b"z" * 700
    whole = [np.concatenate(c).tolist() for c in zip(*sd.anchors(text, 40))]
    monkeypatch.setattr(sd, "CHUNK", 64)
    parts = [np.concatenate(c).tolist() for c in zip(*sd.anchors(text, 40))]
    assert whole == parts


def test_sort_and_common_prefixes():
    random.seed(2)
    values = ["".join(random.choices("ab", k=random.randint(0, 30))).encode() for _ in range(300)]
    rows = sd._matrix(values, 32)
    sizes = np.array([len(v) for v in values])
    order = sd.multikey_sort(rows.view(">u8").astype(np.uint64), sizes)
    assert [values[i] for i in order] == sorted(values)
    shared = sd.common_prefix(rows[order], sizes[order])
    for a, b, n in zip(sorted(values), sorted(values)[1:], shared[1:]):
        assert a[:n] == b[:n] and (len(a) == n or len(b) == n or a[n] != b[n])


def test_odd_rows(documents, clashing, nothing):
    rows = documents.collect()
    expected = dict(zip(((r["doc_id"], r["text"]) for r in rows), brute.without_repeats([r["text"] for r in rows], 400)))
    got = sd.remove_repeats(clashing, length=400).collect()
    assert len(got) == 16
    for r in got:
        assert ([(s["start"], s["stop"]) for s in r["spans"]], bytes(r["kept"])) == expected[r["doc_id"], r["text"]]
    assert "id" in got[0].asDict()
    assert sd.remove_repeats(nothing, length=400).collect() == []


def test_passages_of_short_words_go_and_shorter_ones_stay(spark):
    random.seed(12)
    word = lambda: "".join(random.choices("abcdefghijk", k=random.randint(2, 3)))
    words = lambda n: " ".join(word() for _ in range(n))
    passage, short, other = words(51), words(45), words(45)
    assert len(passage) < 256 and len(short) > 101
    texts = [
        f"{words(70)} {passage} {words(40)}", f"{words(20)} {passage}\n{words(30)}", f"{words(30)} {short} {other} {words(9)}",
        f"{words(12)} {short} {words(30)}", f"{other} {words(25)}", words(300), "a" * 2000, None,
    ]
    docs = spark.createDataFrame([(i // 2, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    got = {r["text"]: r["kept"] for r in sd.remove_passages(docs, as_text=True).collect()}
    assert len(got) == len(texts)
    for text in texts[:2]:
        assert passage not in got[text] and got[text].split() == text.replace(passage, "").split()
    # Two repeated strings in a row are not one: each is of fewer words.
    for text in texts[2:6]:
        assert got[text] == text
    assert got["a" * 2000] == ""


@pytest.mark.parametrize("most", [50_000, 2])
def test_passages_are_words_or_bytes(spark, most):
    texts = corpus(5, 60)
    windows = lambda t: [(m[0].start(), m[-1].end()) for m in zip(*(list(re.finditer(rb"[^ ]+", t))[i:] for i in range(7)))]
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(t[a:b] for t in raw for a, b in windows(t))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: bytes(r["kept"]) for r in sd.remove_passages(docs, words=7, length=60, most=most).collect()}
    for i, (t, (spans, _)) in enumerate(zip(raw, brute.without_repeats(texts, 60))):
        gone = bytearray(len(t))
        for a, b in spans + [(a, b) for a, b in windows(t) if seen[t[a:b]] > 1]:
            gone[a:b] = b"\1" * (b - a)
        assert got[i] == bytes(b for b, g in zip(t, gone) if not g), i


def test_texts_of_one_id_that_collide_in_31_bits_stay_apart(spark):
    passage = "a passage of some length that occurs in more than one text"
    pool = spark.range(400_000).selectExpr(
        "id", f"if(id % 2 = 0, concat(sha1(string(id)), '{passage}'), concat(sha1(string(id)), sha2(string(id), 256))) as text"
    ).selectExpr("id % 2 as clean", "text", "xxhash64(text) & 2147483647 as number")
    other = pool.filter("clean = 1").selectExpr("text as other", "number")
    pairs = pool.filter("clean = 0").join(other, "number").select("text", "other").collect()
    assert pairs
    rows = [(None, t) for pair in pairs for t in pair] + [(0, passage)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r["text"]: bytes(r["kept"]) for r in sd.remove_repeats(docs, length=40).collect()}
    assert kept == {t: rest for (_, t), (_, rest) in zip(rows, brute.without_repeats([t for _, t in rows], 40))}
    assert all(kept[clean].decode() == clean for _, clean in pairs)
