"""Huffman codes and token files: optimal, whole, readable from any block."""

import glob
import heapq
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mobility_lake import session
from mobility_lake.llm import huffman as h
from mobility_lake.llm import queries, word_ids
from mobility_lake.llm import token_file as tf

PATH = queries._tokenizer("byte_bpe_50k.json")
ODD = [
    "", None, " ", "\n\n a", "don't we'll  x", "<|endoftext|> hi <|endoftext|>", "TARİHİ, ŞEHRİ. ", "a b, c.",
    "漢字。テスト, ok.\n word, x.", "\tа,б. 12,3. 4.5 ...,,", "é, é. ​, a.", " word,\nword.  word.\n\nword,",
    "aaaaaaaaa aaaa aaa", "x\u0085y z　w\x1cv",
]


def library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def cost_without_limit(counts):
    heap, cost = [int(c) for c in counts], 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    return cost


@given(st.lists(st.integers(1, 10**12), min_size=1, max_size=60), st.integers(6, 12), st.data())
@settings(max_examples=60, deadline=None)
def test_lengths_and_streams(counts, limit, data):
    counts = np.array(counts)
    free, lengths = h.code_lengths(counts, 63), h.code_lengths(counts, limit)
    if len(counts) > 1:
        assert (counts * free).sum(dtype=object) == cost_without_limit(counts)
        assert sum(2.0**-x for x in lengths) == 1.0
    assert lengths.max() <= limit
    ids = np.arange(len(counts)) * 7
    code = h.Code(ids, lengths)
    codes, bits = code.encoder()
    text = np.array(data.draw(st.lists(st.sampled_from(ids.tolist()), max_size=300)), np.int64)
    stream, offsets = h.pack(text, codes, bits)
    words = np.frombuffer(stream + bytes(16 - len(stream) % 8), ">u8").astype(np.uint64)
    pieces = np.full(-(-len(text) // 16), 16)
    if len(text):
        pieces[-1] = len(text) - 16 * (len(pieces) - 1)
    assert (h.unpack(words, offsets[::16], pieces, code.table(), code.limit) == text).all()


def test_too_many_symbols_raise():
    with pytest.raises(ValueError):
        h.code_lengths(np.ones(5, np.int64), 2)


def test_limited_lengths_are_the_best_ones():
    """All codes of four symbols of two bits at most, and five of three, by trial."""
    for counts, limit, best in (([1, 1, 1, 100], 2, 2 * 103), ([1, 1, 2, 4, 100], 3, 100 + 3 * 8)):
        lengths = h.code_lengths(np.array(counts), limit)
        assert (lengths * counts).sum() == best


def test_ids_of_odd_texts_equal_the_library(monkeypatch):
    monkeypatch.setattr(word_ids, "CACHED_WORDS", 8)  # generations change all the time
    encoder, expected = word_ids.WordIds(PATH), library()
    for texts in (ODD, ODD[::-1], [None], []):
        flat, ends = encoder(pa.array(texts, pa.string()))
        assert [flat[a:b].tolist() for a, b in zip(ends, ends[1:])] == [expected(t) for t in texts]


def written_and_read(spark, docs, folder, **options):
    rows = tf.token_ids(docs, PATH, end_id=2)
    rows.write.parquet(folder + "/rows")
    tf.write(spark.read.parquet(folder + "/rows"), folder + "/file", **options)
    found = tf.with_starts(tf.read(spark, folder + "/file"), folder + "/file").collect()
    return sorted(found, key=lambda r: (r["start"], r["n_tokens"]))


@pytest.mark.parametrize("options", [{}, {"file_ids": 500, "every": 3}])
def test_round_trip_of_odd_rows(spark, clashing, folder, options, monkeypatch):
    monkeypatch.setattr(tf, "BLOCK_IDS", 300)
    rows, expected, at = written_and_read(spark, clashing, folder, **options), library(), 0
    given = sorted(
        [(r["doc_id"], [*expected(r["text"]), 2]) for r in clashing.collect()], key=lambda r: (r[0] is not None, r[0] or 0, len(r[1]))
    )
    assert [r["doc_id"] for r in rows] == [d for d, _ in given]
    for row, (_, ids) in zip(rows, given):
        assert row["start"] == at and row["n_tokens"] == len(ids)
        at += len(ids)
    assert sorted(bytes(r["ids"]) for r in rows) == sorted(np.array(ids, "<u4").tobytes() for _, ids in given)
    files = glob.glob(folder + "/file/blocks/part-*")
    assert len(files) > 1 if options else len(files) == 1
    # Far fewer bits than the two bytes per id that went in.
    assert sum(len(open(f, "rb").read()) for f in files) < 2 * at or options


def test_one_id_in_many_rows_spans_files(spark, folder):
    docs = spark.range(300).select(F.lit(5).alias("doc_id"), F.concat(F.lit("same words "), F.col("id") % 3).alias("text"))
    rows = written_and_read(spark, docs, folder, file_ids=200)
    assert len(rows) == 300 and len({r["file"] for r in rows}) > 3
    assert [r["start"] for r in rows] == [sum(x["n_tokens"] for x in rows[:i]) for i in range(300)]


def test_nothing_and_only_empty_texts(spark, nothing, folder):
    assert written_and_read(spark, nothing, folder) == []
    docs = spark.createDataFrame([(1, None), (2, ""), (None, None)], "doc_id long, text string")
    rows = written_and_read(spark, docs, folder + "/more")
    assert [(r["doc_id"], r["start"], r["n_tokens"], bytes(r["ids"])) for r in rows] == [
        (d, i, 1, b"\2\0\0\0") for i, d in enumerate((None, 1, 2))
    ]


def test_query_equals_the_library(spark, sf):
    expected, at, wanted = library(), 0, []
    for doc_id, text in duckdb.sql(f"select doc_id, text from '{sf}/documents.parquet' order by doc_id").fetchall():
        ids = [*expected(text), 2]
        wanted.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    session.pin(spark)
    assert sorted(map(tuple, queries.QUERIES["op12_huffman_token_file"](spark, sf).collect())) == wanted
