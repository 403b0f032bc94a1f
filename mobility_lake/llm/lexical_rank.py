"""Ranked lexical search by the Best Position Algorithm over impact lists.

The terms of the queries are looked up in every document; a document's row keeps those that
occur, with their counts. Rows are read in shards of bounded size, wherever they lie, so nothing
is shuffled by term or by document. In a shard every term has an impact list, its documents by
falling contribution to a score. A query reads its lists in parallel. A document met for the
first time is looked up in all lists by direct access, which gives its exact score and its
positions. A list's best position is the end of the stretch of positions seen, by either kind of
access, from its head on. No unseen document scores more than the entries behind the best
positions add up to; once that is strictly below the k-th score, the shard is done.

The k-th score is carried on: from a part of the rows (one in `first_part`, by hash) that is worked
before the others, and within a task from shard to shard. It only tells when to stop, so results
are those of all rows.

Queries are worked in blocks of about `block_bytes` of text, which the driver sees, each over
all documents.

Defined results: null texts have no terms; a query without a term, or whose terms occur nowhere, has
no row. Every row of the documents, and every row of the queries, counts for itself, repeated or
not. Equal scores go by document id, a null one last. Of either input only the id and text
columns are used, so other columns may have any name. Empty tables give no rows.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mobility_lake.llm.common import by_bytes, shared_file, written

# Letters and digits of ASCII, the former in lower case, and all that is not ASCII; the rest separates.
FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
BATCH = 8 << 20  # bytes of text at a time
SHARD_POSTINGS = 2 << 20
SHARD_DOCS = 1 << 16
STEP = 128  # positions that a list is read on in the first round; each round reads twice as many
IMPACT_BITS = 36  # a weight is below 2**16, a saturated count below 2**20
FOUND = "item long, doc_id long, score long"
RANKED = [T.StructField("rank", T.IntegerType()), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())]


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(FOLD).split()


@functools.lru_cache(maxsize=2)
def _numbers(name: str) -> dict[bytes, int]:
    """The numbers of a block's terms; one per worker process."""
    listed = Path(SparkFiles.get(name)).read_bytes()
    return {term: i for i, term in enumerate(listed.split(b"\n"))}


def postings(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id long, n long, terms binary, counts binary): each document's number of terms, and those of
    the handed-out file `vocabulary` with how often they occur, 4 bytes each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = _numbers(vocabulary)
        for batch in by_bytes(batches, "text", BATCH):
            found = [t.translate(FOLD).split() for t in pc.fill_null(batch.column("text"), "").cast(pa.binary()).to_pylist()]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            flat = np.fromiter(
                (n for own in found for n in map(numbers.get, own, repeat(-1))), np.int64, int(sizes.sum())
            )
            key = (np.repeat(np.arange(len(found)), sizes) * len(numbers) + flat)[flat >= 0]
            key, counts = np.unique(key, return_counts=True)
            ends = np.searchsorted(key, np.arange(len(found) + 1) * len(numbers)).astype(np.int32) * 4
            columns = [batch.column("doc_id"), pa.array(sizes)]
            for values in (key % len(numbers), counts):
                raw = [None, pa.py_buffer(ends), pa.py_buffer(values.astype("<i4"))]
                columns.append(pa.Array.from_buffers(pa.binary(), len(found), raw))
            yield pa.record_batch(columns, names=["doc_id", "n", "terms", "counts"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, terms binary, counts binary")


def _integers(column: pa.Array) -> np.ndarray:
    """The 4-byte numbers of a binary column in a row."""
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").astype(np.int64)


def document_counts(rows: DataFrame, size: int) -> np.ndarray:
    """How many rows of `postings` hold each of `size` terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(_integers(batch.column("terms")), minlength=size)
        held = np.flatnonzero(total)
        yield pa.record_batch([pa.array(held), pa.array(total[held])], names=["term", "n"])

    found = rows.select("terms").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    out = np.zeros(size, np.int64)
    for row in found.collect():
        out[row["term"]] = row["n"]
    return out


class Shard:
    """Impact lists of some documents, with direct access by document."""

    def __init__(self, ids: np.ndarray, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, size: int) -> None:
        """`doc` (rising), `term` and `impact` of all postings; `ids` are the keys that order equal scores."""
        self.ids = ids
        self.term, self.impact = term, impact
        self.doc_starts = np.searchsorted(doc, np.arange(len(ids) + 1))
        order = np.argsort((term << IMPACT_BITS) | ((1 << IMPACT_BITS) - 1 - impact), kind="stable")
        self.listed_doc, self.listed_impact = doc[order], impact[order]
        self.starts = np.searchsorted(term[order], np.arange(size + 1))
        self.position = np.empty(len(order), np.int64)  # of a document's posting among all lists
        self.position[order] = np.arange(len(order))
        self.met = np.zeros(len(ids), bool)
        self.seen = np.zeros(len(order), bool)
        self.times = np.zeros(size, np.int64)

    def best(self, query: np.ndarray, times: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """(document, score) of the k best documents that score `floor` or more, best first.

        `query` holds distinct terms and `times` how often the query has them.
        """
        own = self.starts[query] < self.starts[query + 1]
        query, times = query[own], times[own]
        self.times[query] = times
        at, stops = self.starts[query].copy(), self.starts[query + 1]
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        touched, least, step = [], floor, STEP
        while True:
            on = at < stops
            # No unseen document scores more than what stands behind the best positions.
            if not on.any() or int((times[on] * self.listed_impact[at[on]]).sum()) < least:
                break
            fresh = np.concatenate([self.listed_doc[a : min(a + step, b)] for a, b in zip(at[on], stops[on])])
            fresh = np.unique(fresh[~self.met[fresh]])
            self.met[fresh] = True
            touched.append((fresh, *self._look_up(fresh)))
            self.seen[touched[-1][2]] = True
            docs, scores = self._top(np.concatenate([docs, fresh]), np.concatenate([scores, touched[-1][1]]), k, least)
            if len(docs) == k:
                least = max(least, int(scores[-1]))
            for i in np.flatnonzero(on):
                at[i] = self._best_position(int(at[i]), int(stops[i]))
            step *= 2
        for fresh, _, positions in touched:
            self.met[fresh] = False
            self.seen[positions] = False
        self.times[query] = 0
        return docs, scores

    def _best_position(self, at: int, stop: int) -> int:
        """The first position not seen."""
        width = 2 * STEP
        while at < stop:
            part = self.seen[at : min(at + width, stop)]
            if not part.all():
                return at + int(part.argmin())
            at, width = at + len(part), 2 * width
        return stop

    def _look_up(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The scores of documents, and the positions of their postings in the query's lists."""
        first, counts = self.doc_starts[docs], self.doc_starts[docs + 1] - self.doc_starts[docs]
        ends = np.cumsum(counts)
        entry = np.repeat(first - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)
        times = self.times[self.term[entry]]
        summed = np.concatenate([[0], np.cumsum(times * self.impact[entry])])
        return summed[ends] - summed[ends - counts], self.position[entry[times > 0]]

    def _top(self, docs: np.ndarray, scores: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        on = scores >= max(1, least)
        docs, scores = docs[on], scores[on]
        order = np.lexsort((self.ids[docs], -scores))[:k]
        return docs[order], scores[order]


class Block:
    """A block's queries by term numbers, its terms' weights and the corpus counts; goes to the tasks."""

    def __init__(self, queries: list[dict[int, int]], weights: np.ndarray, count: int, length: int) -> None:
        self.queries = [(np.array(sorted(q), np.int64), np.array([q[t] for t in sorted(q)], np.int64)) for q in queries]
        self.weights, self.count, self.length = weights, count, length

    def shard(self, batches: list[pa.RecordBatch]) -> Shard:
        counts = np.concatenate([np.asarray(pc.binary_length(b.column("terms")), np.int64) for b in batches]) // 4
        term = np.concatenate([_integers(b.column("terms")) for b in batches])
        often = np.concatenate([_integers(b.column("counts")) for b in batches])
        n = np.concatenate([b.column("n").to_numpy(zero_copy_only=False) for b in batches]).astype(np.int64)
        doc = np.repeat(np.arange(len(n)), counts)
        longer = 75 + np.array([25 * int(x) * self.count // self.length for x in n], np.int64)
        impact = self.weights[term] * ((10**9 * often) // (1000 * often + 12 * longer[doc]))
        on = impact > 0
        ids = pa.chunked_array([b.column("doc_id") for b in batches])
        # A null id goes behind all others; equal keys stand for equal ids.
        known, none = np.unique(np.asarray(ids.drop_null(), np.int64)), np.asarray(ids.is_null(), bool)
        keys = np.full(len(ids), len(known), np.int64)
        keys[~none] = np.searchsorted(known, np.asarray(ids.drop_null(), np.int64))
        return Shard(keys, doc[on], term[on], impact[on], len(self.weights))


def _search(rows: DataFrame, block: Block, k: int, floors: dict[int, int]) -> DataFrame:
    """(item, doc_id, score): the k best rows of each task for each query, those below its floor left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, list[tuple[int, bool, int]]] = {}  # by query: (-score, no id, id) of the best
        least = dict(floors)
        for held in _shards(batches):
            shard = block.shard(held)
            ids = pa.chunked_array([b.column("doc_id") for b in held]).combine_chunks()
            for item, (query, times) in enumerate(block.queries):
                docs, scores = shard.best(query, times, k, least.get(item, 0))
                if len(docs):
                    named = ids.take(pa.array(docs)).to_pylist()
                    new = [(-s, name is None, name or 0) for name, s in zip(named, scores.tolist())]
                    kept[item] = sorted(kept.get(item, []) + new)[:k]
                    if len(kept[item]) == k:
                        least[item] = max(least.get(item, 0), -kept[item][-1][0])
        found = [(i, None if none else name, -score) for i, own in kept.items() for score, none, name in own]
        columns = list(zip(*found)) or [(), (), ()]
        yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["item", "doc_id", "score"])

    return rows.mapInArrow(run, FOUND)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    held, size, docs = [], 0, 0
    for batch in batches:
        new = (pc.sum(pc.binary_length(batch.column("terms"))).as_py() or 0) // 4
        if held and (size + new > SHARD_POSTINGS or docs + len(batch) > SHARD_DOCS):
            yield held
            held, size, docs = [], 0, 0
        held.append(batch)
        size, docs = size + new, docs + len(batch)
    if held:
        yield held


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def rank(
    docs: DataFrame, queries: DataFrame, k: int = 20, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", block_bytes: int = 4 << 20, first_part: int = 32,
) -> DataFrame:
    """(item_id, rank int, doc_id long, score long): the k documents of the highest scores above 0 for each query."""
    spark = docs.sparkSession
    listed = queries.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text"))
    listed = written(listed.withColumn("number", F.monotonically_increasing_id()), "queries")
    blocks = max(1, math.ceil((listed.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / block_bytes))
    kind = listed.schema["item_id"].dataType
    out = spark.createDataFrame([], T.StructType([T.StructField("item_id", kind), *RANKED]))
    for at in range(blocks):
        rows = listed.filter(F.col("number") % blocks == at).select("item_id", "text").collect()
        found = _block_results(docs.select(doc_id, text).toDF("doc_id", "text"), [r["text"] for r in rows], k, first_part)
        if found is not None:
            schema = T.StructType([T.StructField("item_id", kind), T.StructField("item", T.LongType())])
            names = spark.createDataFrame([(r["item_id"], i) for i, r in enumerate(rows)], schema)
            out = out.union(found.join(names, "item").select("item_id", F.col("rank").cast("int"), "doc_id", "score"))
    return out


def _block_results(docs: DataFrame, texts: list[str | None], k: int, first_part: int) -> DataFrame | None:
    wanted = [Counter(terms(t)) for t in texts]
    vocabulary = sorted(set().union(*wanted))
    if not vocabulary:
        return None
    file = shared_file(docs.sparkSession, b"\n".join(vocabulary), "terms")
    rows = written(postings(docs, file), "postings")
    total = rows.agg(F.count_if(F.col("n") > 0).alias("count"), F.sum("n").alias("length")).first()
    if not total["count"]:
        return None
    held = document_counts(rows, len(vocabulary)).tolist()
    weights = [math.floor(1000 * math.log((2 * total["count"] + 2) / (2 * n + 1))) for n in held]
    number = {term: i for i, term in enumerate(vocabulary)}
    queries = [{number[t]: n for t, n in own.items()} for own in wanted]
    block = Block(queries, np.array(weights, np.int64), total["count"], total["length"])
    part = rows.filter(F.pmod(F.xxhash64("doc_id", "terms"), F.lit(first_part)) == 0)
    last = _ranked(_search(part, block, k, {}), k).filter(F.col("rank") == k)
    floors = {r["item"]: r["score"] for r in last.collect()}
    return _ranked(written(_search(rows, block, k, floors), "found"), k)
