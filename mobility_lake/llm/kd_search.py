"""Exact top-k inner products by KD-trees, a tree per shard.

Rows are dealt to shards of about `shard_rows` by a hash, so every shard is a fair sample and
bounded. A shard's tree splits at the median of its widest side, and every node keeps the
tight box of its rows. A query walks the tree best first: no row of a box can score more than
the sum over components of the larger of q * low and q * high, so the walk ends when the best
open box is below the k-th score found so far.

Two passes: a query first searches the shard it is dealt to, then its k-th score goes with it
to all other shards, where most boxes, or the whole tree, fall below it. The queries are a
stated set and meet each shard once; a shard returns at most k rows per query.

Components are whole numbers: `floor(scale * x)` with x as double, of any size. A vector that is null,
empty, or holds a component that is null or not finite (when scaled) takes no part, neither does a
null id. Scores are exact: added as doubles, as longs or as Python's whole numbers, whichever hold them;
one beyond a long has its right rank and is null. Only vectors of the same length are compared. A query never
returns rows of its own id; a query id that occurs twice counts once, with its smallest
vector. Ties go to the smaller id; fewer rows than k give all of them. Repeated rows are
rows of their own. Columns other than id and vector are ignored.
"""

from __future__ import annotations

import heapq
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mobility_lake.llm.common import lanes, written

LEAF = 128
USUAL = 1 << 24  # rows with a larger component have a tree of their own, so that the others stay fast
QUERY_BLOCK = 256


class Tree:
    """Rows of one shard and length; nodes are numbered, children after their parent."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray) -> None:
        self.reach = int(np.abs(rows).max(initial=0)) + 1
        order = np.arange(len(ids))
        low, high, self.children, self.spans = [], [], [], []
        todo = [(0, len(ids), -1, 0)]
        while todo:
            start, stop, parent, side = todo.pop()
            part = rows[order[start:stop]]
            node = len(low)
            low.append(part.min(axis=0))
            high.append(part.max(axis=0))
            self.children.append([-1, -1])
            self.spans.append((start, stop))
            if parent >= 0:
                self.children[parent][side] = node
            width = high[-1] - low[-1]
            wide = int(width.argmax())
            if stop - start > LEAF and width[wide] > 0:
                middle = (stop - start) // 2
                halves = np.argpartition(part[:, wide], middle)
                order[start:stop] = order[start:stop][halves]
                todo.append((start + middle, stop, node, 1))
                todo.append((start, start + middle, node, 0))
        self.low, self.high = np.array(low).T, np.array(high).T
        self.ids, self.rows = ids[order], np.ascontiguousarray(rows[order])
        self.held: dict[type, tuple] = {}

    def _as(self, kind: type) -> tuple:
        if kind not in self.held:
            self.held[kind] = tuple(_exactly(x, kind) for x in (self.low, self.high, self.rows))
        return self.held[kind]

    def search(self, ids: np.ndarray, queries: np.ndarray, k: int, least: np.ndarray) -> list[list]:
        """For each query up to k (score, -id) of at least `least`, best first."""
        found: list[list] = [[] for _ in ids]
        reaches = [int(r) for r in np.abs(queries).max(axis=1, initial=0)]
        kinds = [kind_of(queries.shape[1], self.reach, r + 1) for r in reaches]
        for kind in dict.fromkeys(kinds):
            own = [i for i, k in enumerate(kinds) if k is kind]
            low, high, rows = self._as(kind)
            asked = _exactly(queries[own], kind)
            bounds = np.maximum(asked, 0) @ high + np.minimum(asked, 0) @ low
            for at, i in enumerate(own):
                found[i] = self._one(int(ids[i]), asked[at], rows, bounds[at].tolist(), k, least[i])
        return found

    def _one(self, own: int, query: np.ndarray, rows: np.ndarray, bounds: list, k: int, least: float) -> list:
        best: list[tuple[int, int]] = []  # a heap, its worst first
        open_nodes = [(-bounds[0], 0)]
        while open_nodes:
            bound, node = heapq.heappop(open_nodes)
            if -bound < least:
                break
            left, right = self.children[node]
            if left >= 0:
                heapq.heappush(open_nodes, (-bounds[left], left))
                heapq.heappush(open_nodes, (-bounds[right], right))
                continue
            start, stop = self.spans[node]
            scores = rows[start:stop] @ query
            for at in np.flatnonzero(scores >= least).tolist():
                number = int(self.ids[start + at])
                if number == own:
                    continue
                entry = (int(scores[at]), -number)
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
                if len(best) == k:
                    least = max(least, best[0][0])
        return sorted(best, reverse=True)


def kind_of(size: int, reach: int, other: int) -> type:
    """What holds every partial sum exactly. Doubles do up to 2**53, and add much faster than longs."""
    most = size * reach * other
    return np.float64 if most < 1 << 53 else np.int64 if most < 1 << 62 else object


def _exactly(values: np.ndarray, kind: type) -> np.ndarray:
    if kind is not object:
        return values.astype(kind)
    out = np.empty(values.shape, object)
    out.ravel()[:] = [int(x) for x in values.ravel().tolist()]
    return out


def in_order(number: int) -> bytes:
    """Bytes whose order is that of the numbers."""
    size = -(-number.bit_length() // 8)
    if number >= 0:
        return (0x8000 + size).to_bytes(2, "big") + number.to_bytes(size, "big")
    return (0x7FFF - size).to_bytes(2, "big") + (number + (1 << 8 * size)).to_bytes(size, "big")


def quantised(vector: str, scale: float) -> Column:
    """The whole-number vector, or null for one that takes no part."""
    scaled = F.transform(vector, lambda x: F.lit(float(scale)) * x.cast("double"))
    # A double from 2**53 on is whole, and may be beyond a long.
    whole = F.transform(scaled, lambda x: F.when(F.abs(x) < F.lit(2.0**53), F.floor(x).cast("double")).otherwise(x))
    inside = F.forall(scaled, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return F.when((F.size(vector) > 0) & inside, whole)


def _search(k: int):
    """Rows sorted by shard and length, vectors before queries: found rows of each query."""
    out = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()), ("place", pa.binary())])

    def flush(trees: list[Tree], block: list) -> list[dict]:
        if not trees or not block:
            return []
        ids = np.array([b[0] for b in block], np.int64)
        least = [-math.inf if b[2] is None else b[2] for b in block]
        queries = np.array([b[1] for b in block])
        found = [sum(lists, []) for lists in zip(*(tree.search(ids, queries, k, least) for tree in trees))]
        return [
            {
                "query_id": block[i][0],
                "vec_id": -number,
                "score": score if -(1 << 63) <= score < 1 << 63 else None,
                "place": in_order(score),
            }
            for i, rows in enumerate(found)
            for score, number in sorted(rows, reverse=True)[:k]
        ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = itertools.chain.from_iterable(_groups(batch) for batch in batches)
        for _, group in itertools.groupby(rows, key=lambda r: r[0]):
            trees, ids, vectors, block = [], [], [], []
            for _, query, part_ids, part_vectors, least in group:
                if not query:
                    ids.append(part_ids)
                    vectors.append(part_vectors)
                    continue
                if not trees and ids:
                    held, rows_ = np.concatenate(ids), np.concatenate(vectors)
                    usual = np.abs(rows_).max(axis=1) < USUAL
                    trees = [Tree(held[own], rows_[own]) for own in (usual, ~usual) if own.any()]
                for at in range(len(part_ids)):
                    block.append((int(part_ids[at]), part_vectors[at], least[at]))
                    if len(block) == QUERY_BLOCK:
                        yield pa.RecordBatch.from_pylist(flush(trees, block), out)
                        block = []
            yield pa.RecordBatch.from_pylist(flush(trees, block), out)

    return run


def _groups(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Runs of rows of one shard, length and kind."""
    shard = np.asarray(batch.column("shard"))
    query = np.asarray(batch.column("is_query").cast(pa.int8()))
    size = np.asarray(batch.column("size"))
    if not len(shard):
        return
    change = (np.diff(shard) != 0) | (np.diff(query) != 0) | (np.diff(size) != 0)
    edges = [0, *(np.flatnonzero(change) + 1).tolist(), len(shard)]
    for start, stop in zip(edges, edges[1:]):
        part = batch.slice(start, stop - start)
        flat = np.asarray(part.column("vector").flatten())
        vectors = flat.reshape(stop - start, -1)
        key = (int(shard[start]), int(size[start]))
        yield key, bool(query[start]), np.asarray(part.column("id")), vectors, part.column("least").to_pylist()


def top_k(
    rows: DataFrame,
    is_query: Column,
    row_id: str,
    vector: str,
    k: int = 5,
    scale: float = 256.0,
    shard_rows: int = 8192,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best rows of every query row."""
    spark = rows.sparkSession
    vectors = rows.select(
        F.col(row_id).cast("long").alias("id"), quantised(vector, scale).alias("vector"), is_query.alias("asks")
    ).filter("id is not null and vector is not null")
    vectors = written(vectors.withColumn("size", F.size("vector")), "vectors")
    shards = max(1, -(-vectors.count() // shard_rows))
    home = F.pmod(F.xxhash64("id", "vector"), F.lit(shards)).cast("int")
    schema = ("shard", "size", "is_query", "id", "vector", "least")
    stored = vectors.select(
        home.alias("shard"), "size", F.lit(False).alias("is_query"), "id", "vector", F.lit(None).cast("long").alias("least")
    )
    asked = (
        vectors.filter("asks").groupBy("id").agg(F.min("vector").alias("vector")).withColumn("size", F.size("vector"))
    )
    asked = asked.withColumn("home", home)

    def search(queries: DataFrame) -> DataFrame:
        both = stored.unionByName(queries.withColumn("is_query", F.lit(True)).select(*schema))
        dealt = both.repartition(min(shards, lanes(spark)), "shard").sortWithinPartitions("shard", "size", "is_query")
        return dealt.mapInArrow(_search(k), "query_id long, vec_id long, score long, place binary")

    near = written(
        search(asked.withColumn("shard", F.col("home")).withColumn("least", F.lit(None).cast("long"))), "near"
    )
    found = near
    if shards > 1:
        # The k-th score at home, if there are as many within a long, is the least that counts elsewhere.
        kth = near.groupBy("query_id").agg(
            F.when(F.count("score") >= k, F.min("score")).alias("least")
        )
        others = asked.join(kth, asked["id"] == kth["query_id"], "left").withColumn(
            "shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
        )
        found = near.unionByName(search(others.filter("shard <> home")))
    best = Window.partitionBy("query_id").orderBy(F.desc("place"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
