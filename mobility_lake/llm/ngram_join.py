"""Exact Jaccard self-join of documents on word n-grams, by prefix trees.

1. One pass makes every document's set of shingle hashes: its size, a 128-bit digest (equal
   sets are one class, represented by its smallest id), and a sketch of how many
   documents hold a shingle: fixed counters that every shingle adds to, summed over all documents.
2. The sketch gives one global order of shingles, rare ones first. Two sets that link share one
   of the first `size - ceil(t * size) + 1` of each, so only these prefixes are dealt out by
   shingle. Documents that meet at a shingle, and pass the bounds on length and on what is left
   behind the shingle, are a candidate group. Common shingles (boilerplate, quoted passages) come last
   in the order and stay out of most prefixes.
3. Groups that overlap are gathered into work units of bounded size, first with a signature per document:
   the parity of the shingles that fall on each of its bits. Two signatures that differ in d bits belong to sets
   that differ in d shingles or more, so pairs that cannot reach the threshold are dropped
   for certain, at less than a sixtieth of the bytes of the sets.
4. What is still connected makes the final units, each with the whole sets of
   its documents. A unit stores its sets in a prefix tree in the global order; a probe walks the tree level
   by level, adding up its overlap once per shared path, and drops every subtree whose overlap plus the
   shingles left (in the probe or below the node) cannot reach the threshold. A unit returns no
   more links than join its documents.
5. Components of these links, extended to all members of the classes.

A group of any size is worked whole: above `screen_docs` (signatures) or `unit_docs` (sets) documents its blocks
meet pairwise, each pair as a unit of its own. All links between different components are found or implied, so components are exact.

Shingles are compared by 58-bit hashes. Null or empty texts, and texts without words, have no set
and link with nothing. Ids are whole numbers; of a repeated id with different
texts one set counts, the smallest by size and digest; rows with a null id are left out. An empty table gives no rows. Only the id and the text column are used.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mobility_lake.llm.common import by_bytes, lanes, written
from mobility_lake.llm.components import components

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
ODD = 0x9E3779B97F4A7C15  # an odd multiplier and its inverse modulo 2**64
INVERSE = pow(ODD, -1, 1 << 64)
LETTERS = np.random.default_rng(20240601).integers(1, 1 << 64, 256, dtype=np.uint64)
COUNTERS = 22  # bits: the sketch has this many counters, whatever the input
BLOCK = 1 << 16  # counters that travel together
BATCH = 1 << 19  # bytes of text at a time


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the multiplier and of its inverse, kept as far as they were needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < size:
            for name, factor in (("up", ODD), ("down", INVERSE)):
                factors = np.full(size, factor, np.uint64)
                factors[0] = 1
                setattr(self, name, np.cumprod(factors))
        return self.up[:size], self.down[:size]


_POWERS = _Powers()


def shingles(column: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of the shingles of each text, repeats included; documents rise."""
    values = pc.fill_null(column.cast(pa.binary()), b"").to_pylist()
    raw = np.frombuffer(b" ".join(values).translate(LOWER) + b" ", np.uint8)
    blank = SPACE[raw]
    edge = np.diff(np.concatenate([[1], blank.view(np.int8), [1]]))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    up, down = _POWERS.to(len(raw) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(LETTERS[raw] * up[: len(raw)])])
    word = mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    sizes = np.fromiter(map(len, values), np.int64, len(values)) + 1
    owner = np.searchsorted(np.cumsum(sizes), starts, side="right")
    count = np.bincount(owner, minlength=len(values))
    first = np.cumsum(count) - count
    found_owner, found = [], []
    so_far = word
    for size in range(1, words + 1):
        if size > 1:
            so_far = mixed(so_far[:-1] * np.uint64(ODD) + word[size - 1 :])
        if size < words:  # a shorter text is one shingle
            whole = np.flatnonzero(count == size)
            found_owner.append(whole)
            found.append(so_far[first[whole]])
        else:
            inside = np.flatnonzero(owner[: len(so_far)] == owner[size - 1 :]) if len(so_far) else np.zeros(0, np.int64)
            found_owner.append(owner[inside])
            found.append(so_far[inside])
    owner, hashes = np.concatenate(found_owner), np.concatenate(found)
    order = np.argsort(owner, kind="stable")
    return owner[order], hashes[order]


def distinct_sets(owner: np.ndarray, keys: np.ndarray, documents: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of each document in rising order, and where each document begins."""
    bounds = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=documents))])
    keys = keys.copy()
    for start, stop in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        keys[start:stop].sort()
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
    sizes = np.bincount(owner[new], minlength=documents)
    return keys[new], np.concatenate([[0], np.cumsum(sizes)])


def _needed(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """The least overlap of linked sets of these sizes."""
    return -(-percent * (a + b) // (100 + percent))


def _digests(keys: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit sums over each set."""
    out = []
    for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(keys ^ np.uint64(salt)))])
        out.append((sums[bounds[1:]] - sums[bounds[:-1]]).view(np.int64))
    return out


def signature(keys: np.ndarray) -> bytes:
    """Parity bits of a set: as many as shingles or up to twice as many, a power of two."""
    width = max(64, 1 << len(keys).bit_length())
    parity = np.bincount((keys & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(parity.astype(np.uint8), bitorder="little").tobytes()


def screened(ids: list[int], sizes: np.ndarray, marks: list[bytes], percent: int) -> list[tuple[int, int]]:
    """Edges that connect whatever documents may be connected by links, none of them needless."""
    order = np.argsort(sizes, kind="stable")
    sizes = sizes[order]
    marks = [np.frombuffer(marks[i], np.uint64) for i in order]
    widths = np.array([len(m) for m in marks])
    # Of each width its own signatures, and those of wider ones that a partner may have, folded to it (parities add up).
    wider = (100 // percent).bit_length()
    tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for width in np.unique(widths).tolist():
        rows = np.flatnonzero((widths >= width) & (widths <= width << wider))
        tables[width] = (rows, np.stack([np.bitwise_xor.reduce(marks[i].reshape(-1, width), axis=0) for i in rows]))
    label = np.arange(len(order))
    edges = []
    for i in range(len(order)):
        # Larger partners only, each pair once.
        rows, table = tables[int(widths[i])]
        begin = np.searchsorted(rows, i, side="right")
        end = np.searchsorted(rows, np.searchsorted(sizes, 100 * sizes[i] // percent, side="right"))
        if begin >= end:
            continue
        partners = rows[begin:end]
        apart = np.bitwise_count(table[begin:end] ^ marks[i]).sum(axis=1).astype(np.int64)
        most = (sizes[i] + sizes[partners] - apart) // 2
        may = partners[most >= _needed(sizes[i] + np.zeros(len(partners), np.int64), sizes[partners], percent)]
        for other in np.unique(label[may]).tolist():
            if other != label[i]:
                edges.append((ids[order[i]], ids[order[int(may[label[may] == other][0])]]))
                label[label == other] = label[i]
    return edges


def _screen_units(percent: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, ids, sizes, marks = None, [], [], []

        def flush():
            found = screened(ids, np.array(sizes, np.int64), marks, percent) if len(ids) > 1 else []
            return pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in found], schema)

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("unit", "id", "size", "bits"))):
                if row[0] != current:
                    yield flush()
                    current, ids, sizes, marks = row[0], [], [], []
                if ids and ids[-1] == row[1]:
                    continue
                ids.append(row[1])
                sizes.append(row[2])
                marks.append(row[3])
        yield flush()

    return run, "a long, b long"


def _describe(words: int):
    """Size and digest of every set, and this task's share of the sketch."""
    schema = pa.schema(
        [("id", pa.int64()), ("size", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("bits", pa.binary())]
        + [("block", pa.int32()), ("counts", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << COUNTERS, np.uint16)
        for batch in by_bytes(batches, "text", BATCH):
            n = batch.num_rows
            keys, bounds = distinct_sets(*shingles(batch.column("text"), words), n)
            at, times = np.unique((keys >> np.uint64(64 - COUNTERS)).astype(np.int32), return_counts=True)
            sketch[at] = np.minimum(sketch[at] + times, 60_000)  # a task's share need not be more exact
            digests = _digests(keys, bounds)
            marks = [signature(keys[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            columns = [batch.column("id"), pa.array(np.diff(bounds)), *map(pa.array, digests), pa.array(marks, pa.binary())]
            yield pa.record_batch([*columns, pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], schema=schema)
        if sketch.any():
            # A task's share needs a byte: counts order shingles, they decide nothing.
            blocks = np.minimum(sketch, 255).astype(np.uint8).reshape(-1, BLOCK)
            rows = [{"block": i, "counts": zlib.compress(b.tobytes(), 1)} for i, b in enumerate(blocks)]
            yield pa.RecordBatch.from_pylist(rows, schema)

    return run, "id long, size long, d1 long, d2 long, bits binary, block int, counts binary"


def _order_of(described: DataFrame) -> np.ndarray:
    """The class of every counter of the sketch, a byte each: 0 for what rare shingles add up to, then
    one more for each doubling of the excess over that, in units of its spread."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column("block").to_pylist(), batch.column("counts")):
                counts = np.frombuffer(zlib.decompress(counts.as_py()), np.uint8).astype(np.int64)
                total[block] = total[block] + counts if block in total else counts
        schema = pa.schema([("block", pa.int32()), ("usual", pa.int64()), ("classes", pa.binary())])
        rows = []
        for block, counts in total.items():
            # Most shingles are rare, so the median is what they add to a counter.
            usual = float(np.median(counts))
            excess = (counts - usual) / max(1.0, usual) ** 0.5
            classes = np.where(excess > 2, 1 + np.floor(np.log2(np.maximum(excess, 2))), 0)
            rows.append({"block": block, "usual": int(usual), "classes": classes.astype(np.uint8).tobytes()})
        yield pa.RecordBatch.from_pylist(rows, schema)

    parts = described.filter("block is not null").select("block", "counts")
    count = (1 << COUNTERS) // BLOCK
    summed = parts.repartition(count, "block").mapInArrow(add, "block int, usual long, classes binary")
    classes = np.zeros((count, BLOCK), np.uint8)
    for row in summed.select("block", "classes").collect():  # a byte per counter
        classes[row["block"]] = np.frombuffer(row["classes"], np.uint8)
    return classes.ravel()


def ordered(hashes: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Shingle keys whose natural order is the global one: class in the top 6 bits, then hash."""
    rank = classes[(hashes >> np.uint64(64 - COUNTERS)).astype(np.int64)].astype(np.uint64)
    return (rank << np.uint64(58)) | ((hashes * np.uint64(ODD)) >> np.uint64(6))


def _prefixes(words: int, percent: int, classes: np.ndarray, pieces: int):
    """Prefix shingles of a batch, packed by the piece they are dealt to, with the first digest of their set.

    Sets of one first digest would only be candidates for the same partners. A set's shingles of one piece are
    neighbours: its digest and size go once for each such run, with the run's length.
    """
    schema = pa.schema([("piece", pa.int32())] + [(c, pa.binary()) for c in PACKED])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in by_bytes(batches, "text", 16 * BATCH):
            taken = [[], [], [], []]
            for part in by_bytes([batch], "text", BATCH):
                owner, hashes = shingles(part.column("text"), words)
                digests = _digests(*distinct_sets(owner, hashes, part.num_rows))
                keys, bounds = distinct_sets(owner, ordered(hashes, classes), part.num_rows)
                sizes = np.diff(bounds)
                length = np.where(sizes > 0, sizes - -(-percent * sizes // 100) + 1, 0)
                for at, digest in enumerate(zip(*(d.tolist() for d in digests))):
                    if digest in seen:  # a repeat within the task adds no group
                        length[at] = 0
                    seen.add(digest)
                total = int(length.sum())
                place = np.arange(total) - np.repeat(np.cumsum(length) - length, length)
                owner = np.repeat(np.arange(part.num_rows), length)
                taken[0].append(keys[bounds[owner] + place])
                taken[1].append(digests[0][owner])
                taken[2].append(sizes[owner].astype(np.int32))
                taken[3].append(place.astype(np.int32))
            key, *rest = (np.concatenate(t) for t in taken)
            piece = (mixed(key) % np.uint64(pieces)).astype(np.int32)
            order = np.argsort(piece, kind="stable")
            edges = np.searchsorted(piece[order], np.arange(pieces + 1))
            key, ids, sizes, places = (c[order] for c in (key, *rest))
            changes = np.concatenate([[True], (ids[1:] != ids[:-1]) | (sizes[1:] != sizes[:-1])])
            changes[edges[:-1][edges[:-1] < len(key)]] = True
            starts = np.flatnonzero(changes)
            counts = np.diff(np.concatenate([starts, [len(key)]])).astype(np.int32)
            runs = np.searchsorted(starts, edges)  # the runs of each piece
            rows = [
                {
                    "piece": p, "keys": key[edges[p] : edges[p + 1]].tobytes(), "places": places[edges[p] : edges[p + 1]].tobytes(),
                    "counts": counts[runs[p] : runs[p + 1]].tobytes(), "ids": ids[starts[runs[p] : runs[p + 1]]].tobytes(),
                    "sizes": sizes[starts[runs[p] : runs[p + 1]]].tobytes(),
                }
                for p in range(pieces)
                if edges[p] < edges[p + 1]
            ]
            yield pa.RecordBatch.from_pylist(rows, schema)

    return run, "piece int, " + ", ".join(f"{c} binary" for c in PACKED)


PACKED = ("keys", "places", "counts", "ids", "sizes")


def unpacked(held: dict[str, list[bytes]]) -> tuple[np.ndarray, ...]:
    """Keys, ids, sizes and places of packed prefix shingles, one for each key."""
    kinds = {"keys": np.uint64, "places": np.int32, "counts": np.int32, "ids": np.int64, "sizes": np.int32}
    key, places, counts, ids, sizes = (np.frombuffer(b"".join(held[n]), k) for n, k in kinds.items())
    return key, np.repeat(ids, counts), np.repeat(sizes, counts), places


def _groups(percent: int):
    """Sets that meet at a shingle, by their first digest, from all packed prefixes of a piece."""
    schema = pa.schema([("members", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {name: [] for name in PACKED}
        for batch in batches:
            for name, parts in held.items():
                parts.extend(batch.column(name).to_pylist())
        key, ids, sizes, places = unpacked(held)
        held.clear()
        order = np.argsort(key, kind="stable")
        key = key[order]
        begins = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        counts = np.diff(np.concatenate([begins, [len(key)]]))
        # Most groups are pairs and are handled all at once.
        left = order[begins[counts == 2]]
        right = order[begins[counts == 2] + 1]
        may = _may_link(sizes[left], places[left], sizes[right], places[right], percent) & (ids[left] != ids[right])
        pairs = np.sort(np.stack([ids[left][may], ids[right][may]], axis=1), axis=1)
        pairs = np.unique(pairs, axis=0) if len(pairs) else pairs
        yield pa.record_batch(
            [pa.ListArray.from_arrays(np.arange(0, 2 * len(pairs) + 1, 2, dtype=np.int32), pairs.ravel())], schema=schema
        )
        seen, rows = set(), []
        for begin, count in zip(begins[counts > 2].tolist(), counts[counts > 2].tolist()):
            at = order[begin : begin + count]
            members = np.unique(_linkable(ids[at], sizes[at], places[at], percent))
            if len(members) > 1 and members.tobytes() not in seen:
                seen.add(members.tobytes())
                rows.append(members)
            if len(rows) == 1000:
                yield pa.record_batch([pa.array(rows, schema[0].type)], schema=schema)
                rows = []
        yield pa.record_batch([pa.array(rows, schema[0].type)], schema=schema)

    return run, "members array<long>"


def _may_link(size_a, place_a, size_b, place_b, percent):
    """Whether sets that first share a shingle at these places can still reach the threshold."""
    left = np.minimum(size_a - place_a, size_b - place_b)
    return left >= _needed(size_a.astype(np.int64), size_b.astype(np.int64), percent)


def _linkable(ids, sizes, places, percent):
    """The ids that some other of the group may link with by size and by what is left."""
    left = sizes - places
    order = np.argsort(sizes, kind="stable")
    sizes, left = sizes[order].astype(np.int64), left[order]
    # Partners are within a window of sizes; the most that any of them has left bounds the overlap.
    low = np.searchsorted(sizes, -(-percent * sizes // 100))
    high = np.searchsorted(sizes, 100 * sizes // percent, side="right")
    alone = high - low < 2
    enough = left >= _needed(sizes, -(-percent * sizes // 100), percent)
    return ids[order][enough & ~alone]


class PrefixTree:
    """Sets of rising keys in a tree with one node per unshared run of keys, numbered by level."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
        self.sizes = np.array([len(s) for s in sets], np.int64)
        level = [(order, 0, -1)]  # members in order, keys consumed, parent
        parts, self.starts, self.stops, self.parent = [], [], [], []
        self.leaf, self.least, self.most, self.depth, self.level_ends = [], [], [], [], []
        at = 0
        while level:
            below = []
            for members, used, parent in level:
                first, last = sets[members[0]], sets[members[-1]]
                limit = min(len(first), len(last))
                differ = np.flatnonzero(first[used:limit] != last[used:limit])
                stop = used + int(differ[0]) if len(differ) else limit
                node = len(self.starts)
                run = first[used:stop]
                parts.append(run)
                self.starts.append(at)
                at += len(run)
                self.stops.append(at)
                self.parent.append(parent)
                self.depth.append(stop)
                sizes = self.sizes[members]
                self.least.append(int(sizes.min()))
                self.most.append(int(sizes.max()))
                ended = [m for m in members if len(sets[m]) == stop]
                self.leaf.append(ended)
                rest = [m for m in members if len(sets[m]) > stop]
                begin = 0
                for k in range(1, len(rest) + 1):
                    if k == len(rest) or sets[rest[k]][stop] != sets[rest[begin]][stop]:
                        below.append((rest[begin:k], stop, node))
                        begin = k
            self.level_ends.append(len(self.starts))
            level = below
        self.keys = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        for name in ("starts", "stops", "parent", "least", "most", "depth"):
            setattr(self, name, np.array(getattr(self, name), np.int64))
        self.vocabulary, self.numbers = np.unique(self.keys, return_inverse=True)

    def probe(self, probe: np.ndarray, percent: int) -> list[int]:
        """Members whose set links with the probe."""
        mark = np.zeros(len(self.vocabulary), np.int32)
        spot = np.searchsorted(self.vocabulary, probe)
        spot = spot[spot < len(self.vocabulary)]
        mark[spot[np.isin(self.vocabulary[spot], probe)]] = 1
        hit = mark[self.numbers]
        found: list[int] = []
        overlap = np.zeros(len(self.starts), np.int64)
        alive = np.zeros(len(self.starts), bool)
        size, begin = len(probe), 0
        for end in self.level_ends:
            nodes = np.arange(begin, end)
            if begin:
                nodes = nodes[alive[self.parent[nodes]]]
            begin = end
            if not len(nodes):
                break
            lengths = self.stops[nodes] - self.starts[nodes]
            own = np.repeat(np.arange(len(nodes)), lengths)
            at = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(self.starts[nodes], lengths)
            shared = np.bincount(own, weights=hit[at], minlength=len(nodes)).astype(np.int64)
            above = self.parent[nodes]
            shared += np.where(above >= 0, overlap[above], 0)
            overlap[nodes] = shared
            # Keys of the probe behind the last key of the node can still be shared.
            last = np.where(lengths > 0, self.stops[nodes] - 1, 0)
            behind = size - np.searchsorted(probe, self.keys[last], side="right") if len(self.keys) else size
            behind = np.where(lengths > 0, behind, size)
            possible = shared + np.minimum(behind, self.most[nodes] - self.depth[nodes])
            fits = (percent * self.least[nodes] <= 100 * size) & (100 * self.most[nodes] >= percent * size)
            alive[nodes] = fits & (possible >= _needed(np.full(len(nodes), size), self.least[nodes], percent))
            for node in nodes[alive[nodes]].tolist():
                for member in self.leaf[node]:
                    union = size + int(self.sizes[member]) - int(overlap[node])
                    if 100 * int(overlap[node]) >= percent * union:
                        found.append(member)
        return found


def joined(ids: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that connect whatever documents of a unit are connected, none of them needless."""
    tree = PrefixTree(sets)
    top = list(range(len(ids)))

    def root(i: int) -> int:
        while top[i] != i:
            top[i] = top[top[i]]
            i = top[i]
        return i

    links = []
    for i, probe in enumerate(sets):
        for j in tree.probe(probe, percent):
            if i != j and root(i) != root(j):
                top[root(i)] = root(j)
                links.append((ids[i], ids[j]))
    return links


def _join_units(percent: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, ids, sets = None, [], []

        def flush():
            found = joined(ids, sets, percent) if len(ids) > 1 else []
            return pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in found], schema)

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("unit", "id")]
            for unit, number, keys in zip(*columns, batch.column("keys")):
                if unit != current:
                    yield flush()
                    current, ids, sets = unit, [], []
                if ids and ids[-1] == number:
                    continue
                ids.append(number)
                sets.append(np.frombuffer(keys.as_py(), np.uint64))
        yield flush()

    return run, "a long, b long"


def _sets(words: int, classes: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text", BATCH):
            owner, hashes = shingles(batch.column("text"), words)
            digests = _digests(*distinct_sets(owner, hashes, batch.num_rows))
            keys, bounds = distinct_sets(owner, ordered(hashes, classes), batch.num_rows)
            packed = [keys[a:b].tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            columns = [batch.column("unit"), batch.column("id"), pa.array(np.diff(bounds)), *map(pa.array, digests)]
            columns.append(pa.array(packed, pa.binary()))
            yield pa.record_batch(columns, names=["unit", "id", "size", "d1", "d2", "keys"])

    return run, "unit string, id long, size long, d1 long, d2 long, keys binary"


def _units(groups: DataFrame, unit_docs: int) -> DataFrame:
    """(id, unit): the work units each candidate document takes part in.

    Groups that overlap make one unit as long as it has at most `unit_docs` documents. Beyond
    that every group is a unit of its own, and one that is still larger is cut into blocks, of which every
    two make a unit.
    """
    groups = written(groups.withColumn("group", F.xxhash64("members")), "groups")
    stars = groups.select(F.explode("members").alias("a"), F.element_at("members", 1).alias("b"))
    clusters = written(components(stars), "clusters")
    sizes = clusters.groupBy("component").agg(F.count("node").alias("docs"))
    small = clusters.join(sizes.filter(F.col("docs") <= unit_docs), "component")
    small = small.select(F.col("node").alias("id"), F.concat(F.lit("c"), F.col("component")).alias("unit"))
    large = sizes.filter(F.col("docs") > unit_docs).select("component")
    if large.isEmpty():
        return small
    hubs = clusters.join(large, "component").select(F.col("node").alias("hub"))
    alone = groups.withColumn("hub", F.element_at("members", 1)).join(hubs, "hub")
    blocks = F.ceil(F.size("members") / F.lit(unit_docs)).cast("int")
    member = alone.select(
        "members", blocks.alias("blocks"), F.xxhash64("members").alias("group"), F.explode("members").alias("id")
    ).drop("members")
    block = member.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    other = block.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    unit = F.concat_ws(
        "-", F.lit("g"), "group", "blocks", F.least("block", "other").cast("string"), F.greatest("block", "other").cast("string")
    )
    return small.union(other.select("id", unit.alias("unit")))


def _blocks(clusters: DataFrame, unit_docs: int) -> DataFrame:
    """(id, unit) of final units: a cluster, or any two blocks of a cluster that is larger than `unit_docs`."""
    sizes = clusters.groupBy("component").agg(F.ceil(F.count("node") / F.lit(unit_docs)).cast("int").alias("blocks"))
    block = clusters.join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = block.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    names = [F.col("component"), F.least("block", "other"), F.greatest("block", "other")]
    return other.select(F.col("node").alias("id"), F.concat_ws("-", *(n.cast("string") for n in names)).alias("unit"))


FILTER = 23  # bits of the row filter, as a power of two


def split_likely(rows: DataFrame, wanted: DataFrame, row_id: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose id may be among the wanted ones, and rows whose id certainly is not; nothing is shuffled.

    An id hashes to a bit, which is set if some wanted id hashes to it. The bits are a table of at most
    2**17 rows whatever the number of ids, so it is broadcast. The more ids are wanted the more rows may be; a
    join behind this decides.
    """
    bit = F.pmod(F.xxhash64(row_id), F.lit(1 << FILTER)).cast("int")
    bits = wanted.select(bit.alias("bit")).groupBy(F.expr("int(bit div 64)").alias("_word"))
    words = bits.agg(F.bit_or(F.expr("shiftleft(1L, bit % 64)")).alias("_bits"))
    marked = rows.withColumn("_bit", bit).withColumn("_word", F.expr("int(_bit div 64)"))
    marked = marked.join(F.broadcast(words), "_word", "left")
    may = F.expr("coalesce(shiftrightunsigned(_bits, _bit % 64) & 1 = 1, false)")
    return marked.filter(may).select(rows.columns), marked.filter(~may).select(rows.columns)


def _likely(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows that a join with the wanted ids can keep, before their texts are shuffled."""
    return split_likely(rows, wanted, "id")[0]


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 75, unit_docs: int = 2048,
    screen_docs: int = 8192,
) -> DataFrame:
    """(id column, `n_shingles`, `component_id`) for every row with an id: the smallest id reachable by links."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).filter("id is not null")
    described = written(rows.mapInArrow(*_describe(words)), "described")
    classes = _order_of(described)
    given = described.filter("block is null").select("id", "size", "d1", "d2")
    marked = described.filter("block is null").select("id", "size", "d1", "d2", "bits")
    sets = given.groupBy("id").agg(F.min(F.struct("size", "d1", "d2")).alias("s")).select("id", "s.*")
    same = written(sets.filter("size > 0").groupBy("size", "d1", "d2").agg(F.min("id").alias("class")), "classes")
    member = written(sets.join(same, ["size", "d1", "d2"], "left").select("id", "size", "class"), "members")

    shared = spark.sparkContext.broadcast(classes)  # a byte per counter
    pieces = lanes(spark)

    def prefixes(batches):
        return _prefixes(words, percent, shared.value, pieces)[0](batches)

    def whole_sets(batches):
        return _sets(words, shared.value)[0](batches)

    packed = rows.mapInArrow(prefixes, "piece int, " + ", ".join(f"{c} binary" for c in PACKED))
    met = packed.repartitionById(pieces, F.col("piece")).mapInArrow(*_groups(percent)).distinct()
    # Members by class; equal sets need no candidate, sets that do not count for an id have no class.
    met = written(met.withColumn("group", F.xxhash64("members")), "met")
    named = met.select("group", "members", F.explode("members").alias("d1")).join(same.select("d1", "class"), "d1")
    groups = (
        named.groupBy("members").agg(F.array_sort(F.collect_set("class")).alias("classes"))
        .select(F.col("classes").alias("members")).filter(F.size("members") > 1).distinct()
    )
    screens = written(_units(groups, screen_docs).distinct(), "screens")
    signs = _likely(marked, screens).join(screens, "id").select("unit", "id", "size", "d1", "d2", "bits")
    # Rows of one id are neighbours, the set that counts first.
    dealt = signs.repartition(lanes(spark), "unit").sortWithinPartitions("unit", "id", "size", "d1", "d2")
    edges = dealt.mapInArrow(*_screen_units(percent))
    units = written(_blocks(components(edges), unit_docs), "units")
    work = _likely(rows, units).join(units, "id").select("unit", "id", "text").mapInArrow(
        whole_sets, "unit string, id long, size long, d1 long, d2 long, keys binary"
    )
    # Rows of one id are neighbours, the set that counts first.
    dealt = work.repartition(lanes(spark), "unit").sortWithinPartitions("unit", "id", "size", "d1", "d2")
    links = dealt.select("unit", "id", "keys").mapInArrow(*_join_units(percent))
    own = member.filter("class is not null and class <> id").select(F.col("id").alias("a"), F.col("class").alias("b"))
    reached = components(links.unionByName(own))
    results = member.join(reached, member["id"] == reached["node"], "left").select(
        member["id"].alias("m"), F.col("size").alias("n_shingles"), F.coalesce("component", member["id"]).alias("component_id")
    )
    return given.join(results, given["id"] == results["m"]).select(F.col("id").alias(doc_id), "n_shingles", "component_id")
