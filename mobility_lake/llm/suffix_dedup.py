"""Removing repeated byte strings by sorting sampled suffixes.

A byte goes if some string of `length` bytes (a window) that covers it also starts anywhere
else. Sorting all suffixes of a corpus would move every byte hundreds of times; sorting a sample
is enough if equal windows hold the same sampled suffixes. So:

1. Anchors. In every window the place whose `length / 2` bytes hash lowest (the leftmost of equals) is an
   anchor; equal windows have their anchor at the same offset, and neighbouring windows share
   theirs, about one per hundred bytes. An anchor goes out with the hash of its leading bytes and a
   digest of its surroundings: everything that any window with this anchor can cover.
2. Anchors whose leading bytes occur once are done. Those whose surroundings occur twice or more have all their
   windows repeated: copies of any number are settled by counting, and one of them stands for all.
3. The rest are suffixes to compare. Sampled splitters range-partition them by their leading bytes, so a
   boundary never separates suffixes that agree in these and nothing has to be compared across it. A bucket sorts its
   suffixes by multikey quicksort with 8-byte symbols, takes the longest common prefix of neighbours, and for every
   offset of the anchor in a window looks for equal left sides within the runs that agree to the window's
   end. The outermost repeated windows of an anchor bound what it removes.
4. Documents meet their intervals, which are merged.

More than `most` different suffixes with equal leading bytes are not sorted in one task: each
gives the digests of all its windows instead, and equal ones are counted. The result is the same.

Texts are UTF-8 bytes; null is empty. Matches never cross documents, they may overlap within
one. Equal rows are documents of their own, so each repeats the other. Ids are whole numbers and may
be null or repeat: documents are told apart by id and text (two 64-bit hashes of both). An empty table gives no rows. Columns of the
input pass through; `spans`, `kept` and names that start with `_` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mobility_lake.llm.common import by_bytes, lanes, written
from mobility_lake.llm.ngram_join import split_likely
from mobility_lake.llm.ngram_join import LETTERS, ODD, SPACE, _POWERS, mixed

CHUNK = 1 << 20  # bytes of a text at a time
LOW = np.uint64((1 << 32) - 1)
FIELDS = ("keys", "digests", "ids", "texts", "places", "before", "behind")
KINDS = (np.uint64, np.uint64, np.int64, np.int64, np.int32, np.int16, np.int16)


def anchors(text: bytes, length: int) -> list[tuple[np.ndarray, ...]]:
    """(place, leading hash, digest, bytes before, bytes behind) of each anchor, chunk by chunk."""
    lead, size = length // 2, len(text)
    width = length - lead + 1  # places in a window
    out, last = [], -1
    for start in range(0, size - length + 1, CHUNK):
        base = max(0, start - width)
        raw = np.frombuffer(text[base : start + CHUNK + 2 * length], np.uint8)
        n = len(raw)
        up, down = _POWERS.to(n + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(LETTERS[raw] * up[:n])])
        count = n - lead + 1
        hashes = mixed((sums[lead:] - sums[:count]) * down[:count])
        # The hash on top and the place below it: the least is the leftmost of the lowest.
        value = (hashes & ~LOW) | np.arange(count, dtype=np.uint64)
        windows = min(CHUNK, size - length + 1 - start)
        least = _sliding_least(value[start - base : start - base + windows + width - 1], width)
        place = np.unique((least & LOW).astype(np.int64))
        place = place[place + base > last]
        if not len(place):
            continue
        last = int(place[-1]) + base
        whole = place + base
        before = np.minimum(width - 1, whole)
        behind = np.minimum(length, size - whole)
        digest = mixed((sums[place + behind] - sums[place - before]) * down[place - before])
        digest = mixed(digest + (before * (length + 1) + behind).astype(np.uint64))
        out.append((whole, hashes[place], digest, before, behind))
    return out


def _sliding_least(value: np.ndarray, width: int) -> np.ndarray:
    """The least of every `width` neighbours, from running minima of blocks."""
    windows = len(value) - width + 1
    blocks = np.concatenate([value, np.full(-len(value) % width, ~np.uint64(0), np.uint64)]).reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:windows], left[width - 1 : width - 1 + windows])


def _covered(place, before, behind, length):
    """What all windows of an anchor cover; an anchor comes from a window, so there is one."""
    least = np.maximum(0, length - behind.astype(np.int64))  # smallest offset in a window
    return place - before.astype(np.int64), place - least + length


def _send(length: int, pieces: int):
    """Anchors of all texts, packed by the piece their leading hash is dealt to."""
    schema = pa.schema([("piece", pa.int32())] + [(f, pa.binary()) for f in FIELDS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text", 16 << 20):
            taken: list[list[np.ndarray]] = [[] for _ in FIELDS]
            ids = np.asarray(batch.column("id"))
            numbers = np.asarray(batch.column("_text"))
            texts = pc.fill_null(batch.column("text").cast(pa.binary()), b"")
            for at in range(batch.num_rows):
                text = texts[at].as_py()
                if len(text) < length:
                    continue
                for place, key, digest, before, behind in anchors(text, length):
                    n = len(place)
                    parts = (key, digest, np.full(n, ids[at]), np.full(n, numbers[at]), place, before, behind)
                    for own, part, kind in zip(taken, parts, KINDS):
                        own.append(part.astype(kind))
            if not taken[0]:
                continue
            columns = [np.concatenate(t) for t in taken]
            piece = (mixed(columns[0]) % np.uint64(pieces)).astype(np.int32)
            order = np.argsort(piece, kind="stable")
            edges = np.searchsorted(piece[order], np.arange(pieces + 1)).tolist()
            columns = [c[order] for c in columns]
            used = [p for p in range(pieces) if edges[p] < edges[p + 1]]
            packed = [pa.array([c[edges[p] : edges[p + 1]].tobytes() for p in used], pa.binary()) for c in columns]
            yield pa.record_batch([pa.array(used, pa.int32()), *packed], schema=schema)

    return run, "piece int, " + ", ".join(f"{f} binary" for f in FIELDS)


def _settle(length: int, most: int):
    """Count leading hashes and surroundings of a piece: intervals of what is settled, suffixes to compare."""
    schema = pa.schema(
        [("id", pa.int64()), ("_text", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())]
        + [("key", pa.int64()), ("single", pa.bool_()), ("many", pa.bool_())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[bytes]] = [[] for _ in FIELDS]
        for batch in batches:
            for own, field in zip(held, FIELDS):
                own.extend(batch.column(field).to_pylist())
        key, digest, ids, texts, place, before, behind = (
            np.frombuffer(b"".join(own), kind) for own, kind in zip(held, KINDS)
        )
        if not len(key):
            return
        order = np.lexsort((digest, key))
        key, digest = key[order], digest[order]
        new_key = np.concatenate([[True], key[1:] != key[:-1]])
        new = new_key | np.concatenate([[True], digest[1:] != digest[:-1]])
        group, alike = np.cumsum(new_key) - 1, np.cumsum(new) - 1
        copies = np.bincount(alike)[alike]
        kinds = np.bincount(group[new])[group]
        start, stop = _covered(place[order], before[order], behind[order], length)
        ids, texts = ids[order], texts[order]

        def rows(which, begin, end, with_key):
            n = len(which)
            none = lambda kind: pa.nulls(n, kind)
            extra = (
                [pa.array(key[which].view(np.int64)), pa.array(copies[which] == 1), pa.array(kinds[which] > most)]
                if with_key
                else [none(pa.int64()), none(pa.bool_()), none(pa.bool_())]
            )
            return pa.record_batch(
                [pa.array(ids[which]), pa.array(texts[which]), pa.array(begin), pa.array(end), *extra], schema=schema
            )

        settled = np.flatnonzero(copies > 1)
        yield rows(settled, start[settled], stop[settled], False)
        compare = np.flatnonzero(new & (kinds > 1))
        at = place[order].astype(np.int64)[compare]
        yield rows(compare, at, at, True)

    return run, "id long, _text long, start long, stop long, key long, single boolean, many boolean"


def _surround(length: int):
    """The bytes around each suffix to compare."""
    width = length - length // 2 + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text", 4 << 20):
            out: dict[str, list] = {n: [] for n in ("id", "_text", "place", "key", "single", "many", "left", "right")}
            ids, numbers = batch.column("id").to_pylist(), batch.column("_text").to_pylist()
            texts = pc.fill_null(batch.column("text").cast(pa.binary()), b"")
            for at, wanted in enumerate(batch.column("wanted").to_pylist()):
                text = texts[at].as_py()
                for w in wanted:
                    place = w["start"]
                    out["id"].append(ids[at])
                    out["_text"].append(numbers[at])
                    out["place"].append(place)
                    out["left"].append(text[max(0, place - width + 1) : place][::-1])
                    out["right"].append(text[place : place + length])
                    for name in ("key", "single", "many"):
                        out[name].append(w[name])
            yield pa.RecordBatch.from_pydict(out, SURROUNDED)

    return run


SURROUNDED = pa.schema(
    [("id", pa.int64()), ("_text", pa.int64()), ("place", pa.int64()), ("key", pa.int64()), ("single", pa.bool_())]
    + [("many", pa.bool_()), ("left", pa.binary()), ("right", pa.binary())]
)
SURROUNDED_SQL = "id long, _text long, place long, key long, single boolean, many boolean, left binary, right binary"


def multikey_sort(words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The order of rows of 8-byte symbols: rows that agree so far are split by the next symbol,
    all such runs at once; runs of one row are done. Rows alike in all symbols go by size."""
    count = len(words)
    order, run = np.arange(count), np.zeros(count, np.int64)
    for symbols in (*words.T, sizes):
        same = run[1:] == run[:-1]
        open_rows = np.flatnonzero(np.concatenate([[False], same]) | np.concatenate([same, [False]]))
        if not len(open_rows):
            break
        own, value = run[open_rows], symbols[order[open_rows]]
        sort = np.lexsort((value, own))
        own, value = own[sort], value[sort]
        order[open_rows] = order[open_rows][sort]
        split = np.concatenate([[True], (own[1:] != own[:-1]) | (value[1:] != value[:-1])])
        # A run is named by the place of its first row, so names rise over all rows.
        run[open_rows] = np.maximum.accumulate(np.where(split, open_rows, 0))
    return order


def common_prefix(rows: np.ndarray, sizes: np.ndarray, block: int = 4096) -> np.ndarray:
    """How many leading bytes each row shares with the one before; 0 for the first."""
    shared = np.zeros(len(rows), np.int64)
    for begin in range(1, len(rows), block):
        end = min(len(rows), begin + block)
        differ = rows[begin:end] != rows[begin - 1 : end - 1]
        first = differ.argmax(axis=1)
        shared[begin:end] = np.where(differ[np.arange(end - begin), first], first, rows.shape[1])
    shared[1:] = np.minimum(shared[1:], np.minimum(sizes[1:], sizes[:-1]))
    return shared


def _matrix(values: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(v.ljust(width, b"\0") for v in values), np.uint8).reshape(len(values), width)


def repeated_windows(left: list[bytes], right: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """The smallest and largest offset of an anchor in a repeated window; largest -1 for none.

    `left` is reversed: its first byte stands before the anchor.
    """
    lead = length // 2
    padded = -(-length // 8) * 8
    rows = _matrix(right, padded)
    sizes = np.fromiter(map(len, right), np.int64, len(right))
    order = multikey_sort(rows.view(">u8").astype(np.uint64), sizes)
    rows, sizes = rows[order], sizes[order]
    shared = common_prefix(rows, sizes)
    shared_next = np.concatenate([shared[1:], [0]])
    before = _matrix(left, max(1, length - lead))[order]
    room = np.fromiter(map(len, left), np.int64, len(left))[order]
    smallest, largest = np.full(len(order), length, np.int64), np.full(len(order), -1, np.int64)
    side = np.zeros(len(order), np.uint64)
    for offset in range(length - lead + 1):
        if offset:
            side = side * np.uint64(ODD) + LETTERS[before[:, offset - 1]]
        depth = length - offset
        run = np.cumsum(shared < depth)
        open_rows = np.flatnonzero(((shared >= depth) | (shared_next >= depth)) & (room >= offset) & (sizes >= depth))
        if not len(open_rows):
            continue
        key = mixed(mixed(run[open_rows].astype(np.uint64)) ^ mixed(side[open_rows]))
        sort = np.argsort(key)
        same = key[sort][1:] == key[sort][:-1]
        twice = open_rows[sort[np.concatenate([same, [False]]) | np.concatenate([[False], same])]]
        smallest[twice] = np.minimum(smallest[twice], offset)
        largest[twice] = offset
    out_small, out_large = np.empty_like(smallest), np.empty_like(largest)
    out_small[order], out_large[order] = smallest, largest
    return out_small, out_large


INTERVALS = pa.schema([("id", pa.int64()), ("_text", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())])
INTERVALS_SQL = "id long, _text long, start long, stop long"


def _compare(length: int):
    """A bucket of suffixes, whole: sorted and compared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [batch for batch in batches if batch.num_rows]
        if not parts:
            return
        bucket = pa.Table.from_batches(parts).combine_chunks()
        small, large = repeated_windows(bucket.column("left").to_pylist(), bucket.column("right").to_pylist(), length)
        place = np.asarray(bucket.column("place"))
        # What occurs twice with all its surroundings is settled; it is here for the others.
        found = np.flatnonzero((large >= 0) & np.asarray(bucket.column("single")))
        kept = bucket.take(pa.array(found))
        columns = [kept.column("id").combine_chunks(), kept.column("_text").combine_chunks()]
        columns += [pa.array(place[found] - large[found]), pa.array(place[found] - small[found] + length)]
        yield pa.record_batch([_one(c) for c in columns], schema=INTERVALS)

    return run


def _one(column) -> pa.Array:
    return pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column


def _windows(length: int):
    """Two digests of each window of a suffix that is one of very many."""
    lead = length // 2
    schema = pa.schema(
        [("id", pa.int64()), ("_text", pa.int64()), ("start", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                whole = np.frombuffer(row["left"][::-1] + row["right"], np.uint8)
                offsets = np.arange(max(0, length - len(row["right"])), min(length - lead, len(row["left"])) + 1)
                begin = len(row["left"]) - offsets
                up, down = _POWERS.to(len(whole) + 1)
                digests = []
                for letters in (LETTERS, mixed(LETTERS)):
                    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(letters[whole] * up[: len(whole)])])
                    digests.append(mixed((sums[begin + length] - sums[begin]) * down[begin]).view(np.int64))
                n = len(offsets)
                yield pa.record_batch(
                    [
                        pa.array([row["id"]] * n, pa.int64()),
                        pa.array([row["_text"]] * n, pa.int64()),
                        pa.array(row["place"] - offsets),
                        *map(pa.array, digests),
                    ],
                    schema=schema,
                )

    return run, "id long, _text long, start long, d1 long, d2 long"


def _remove(passed: list[str], as_text: bool):
    """Merge the intervals of each document and cut them out."""
    kind = pa.string() if as_text else pa.binary()
    names = [*passed, "spans", "kept"]
    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "_body", 8 << 20):
            spans, kept = [], []
            texts = pc.fill_null(batch.column("_body").cast(pa.binary()), b"")
            for at, found in enumerate(batch.column("_found").to_pylist()):
                text = texts[at].as_py()
                merged = _merged(found)
                edges = [0, *(x for pair in merged for x in pair), len(text)]
                rest = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])) if merged else text
                kept.append(rest.decode("utf-8", "ignore") if as_text else rest)
                spans.append([{"start": a, "stop": b} for a, b in merged])
            columns = [batch.column(c) for c in passed]
            yield pa.record_batch([*columns, pa.array(spans, span), pa.array(kept, kind)], names=names)

    return run


def _string_rows(words: int, length: int):
    """The strings that a document's intervals cover, of at least `words` words or `length` bytes."""
    schema = pa.schema(
        [("id", pa.int64()), ("_text", pa.int64()), ("start", pa.int64()), ("body", pa.binary())]
        + [("opens", pa.bool_()), ("closes", pa.bool_())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text", 4 << 20):
            out: dict[str, list] = {n: [] for n in schema.names}
            ids, numbers = batch.column("id").to_pylist(), batch.column("_text").to_pylist()
            texts = pc.fill_null(batch.column("text").cast(pa.binary()), b"")
            for at, found in enumerate(batch.column("_found").to_pylist()):
                text = texts[at].as_py()
                for start, stop in _merged(found):
                    body = text[start:stop]
                    if len(body) < length and len(body.split()) < words:
                        continue
                    # Whether the words at its ends are whole.
                    opens, closes = not text[max(0, start - 1) : start].strip(), not text[stop : stop + 1].strip()
                    for own, value in zip(out.values(), (ids[at], numbers[at], start, body, opens, closes)):
                        own.append(value)
            yield pa.RecordBatch.from_pydict(out, schema)

    return run, "id long, _text long, start long, body binary, opens boolean, closes boolean"


def _word_windows(words: int):
    """Two digests of every string of `words` whole words, from the first one's start to the last one's end."""
    schema = pa.schema([(n, pa.int64()) for n in ("id", "start", "stop", "d1", "d2")] + [("_text", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "body", 1 << 20):
            columns = [batch.column(c).to_pylist() for c in ("id", "_text", "start", "body", "opens", "closes")]
            taken: list[list[np.ndarray]] = [[] for _ in schema]
            for number, text, start, body, opens, closes in zip(*columns):
                whole = np.frombuffer(body, np.uint8)
                edge = np.diff(np.concatenate([[1], SPACE[whole].view(np.int8), [1]]))
                begin, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
                keep = (opens | (begin > 0)) & (closes | (end < len(whole)))
                begin, end = begin[keep], end[keep]
                n = len(begin) - words + 1
                if n < 1:
                    continue
                begin, end = begin[:n], end[words - 1 :]
                up, down = _POWERS.to(len(whole) + 1)
                digests = []
                for letters in (LETTERS, mixed(LETTERS)):
                    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(letters[whole] * up[: len(whole)])])
                    value = (sums[end] - sums[begin]) * down[begin]
                    digests.append(mixed(value + (end - begin).astype(np.uint64)).view(np.int64))
                parts = (np.full(n, number), begin + start, end + start, *digests, np.full(n, text))
                for own, part in zip(taken, parts):
                    own.append(part)
            if taken[0]:
                yield pa.record_batch([pa.array(np.concatenate(t)) for t in taken], schema=schema)

    return run, "id long, start long, stop long, d1 long, d2 long, _text long"


def _merged(found: list[dict] | None) -> list[list[int]]:
    merged: list[list[int]] = []
    for interval in sorted((i["start"], i["stop"]) for i in found or ()):
        if merged and interval[0] <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], interval[1])
        else:
            merged.append(list(interval))
    return merged


def _numbered(docs: DataFrame, doc_id: str, text: str) -> tuple[Column, Column]:
    """What tells documents apart: two hashes of the id and the text. Hashing skips nulls, so null is a value of its own."""
    own = F.col(doc_id).cast("long")
    parts = (own.isNull(), own, F.coalesce(F.col(text), F.lit("")))
    return F.xxhash64(F.lit(1), *parts), F.xxhash64(F.lit(2), *parts)


def _together(intervals: DataFrame) -> DataFrame:
    """All intervals of each document."""
    return intervals.groupBy("id", "_text").agg(F.collect_set(F.struct("start", "stop")).alias("_found"))


def _repeats(rows: DataFrame, length: int, most: int) -> DataFrame:
    """(id, _text, start, stop): what repeated windows cover in documents (id, _text, text)."""
    pieces = lanes(rows.sparkSession)
    sent = rows.mapInArrow(*_send(length, pieces)).repartitionById(pieces, F.col("piece"))
    settled = written(sent.mapInArrow(*_settle(length, most)), "settled")

    wanted = settled.filter("key is not null").groupBy("id", "_text").agg(
        F.collect_list(F.struct("start", "key", "single", "many")).alias("wanted")
    )
    # Only texts that may hold a wanted window are shuffled.
    likely, _ = split_likely(rows, settled.filter("key is not null").select("id"), "id")
    around = likely.join(wanted, ["id", "_text"]).mapInArrow(_surround(length), SURROUNDED_SQL)
    around = written(around, "suffixes")
    # Range partitions by the bytes that all windows of an anchor share.
    lead = F.substring("right", 1, length // 2)
    dealt = around.filter("not many").repartitionByRange(pieces, lead)
    compared = dealt.mapInArrow(_compare(length), INTERVALS_SQL)
    intervals = settled.filter("key is null").select("id", "_text", "start", "stop").unionByName(compared)
    # A window may hold several anchors of one document; it counts once.
    windows = around.filter("many").mapInArrow(*_windows(length)).distinct()
    # A suffix that stands for several counts as often; its own windows are settled anyway.
    twice = windows.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    hit = windows.join(twice, ["d1", "d2"], "left_semi").select("id", "_text", "start", (F.col("start") + length).alias("stop"))
    return intervals.unionByName(hit)


def _cut(docs: DataFrame, doc_id: str, text: str, intervals: DataFrame, as_text: bool) -> DataFrame:
    """`docs` with `spans` and `kept`."""
    passed = [c for c in docs.columns if c not in ("spans", "kept") and not c.startswith("_")]
    found = written(_together(intervals).withColumnsRenamed({"id": "_of", "_text": "_of_text"}), "intervals")
    key, number = _numbered(docs, doc_id, text)
    whole = docs.select(*passed, key.alias("_id"), number.alias("_number"), F.col(text).alias("_body"))
    # Texts without an interval stay where they are.
    may, stays = split_likely(whole, found.select(F.col("_of").alias("_id")), "_id")
    met = may.join(found, (F.col("_id") == F.col("_of")) & (F.col("_number") == F.col("_of_text")), "left")
    stays = stays.withColumn("_found", F.lit(None).cast(found.schema["_found"].dataType))
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())]))
    fields = [docs.schema[c] for c in passed]
    schema = T.StructType([*fields, T.StructField("spans", span), T.StructField("kept", T.StringType() if as_text else T.BinaryType())])
    both = met.select(*passed, "_body", "_found").unionByName(stays.select(*passed, "_body", "_found"))
    return both.mapInArrow(_remove(passed, as_text), schema)


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 400, most: int = 50_000,
    as_text: bool = False,
) -> DataFrame:
    """`docs` with `spans`, the removed byte ranges, and `kept`, the remaining bytes.

    `as_text` gives `kept` as a string, without the rests of characters that were cut into.
    """
    key, number = _numbered(docs, doc_id, text)
    rows = docs.select(key.alias("id"), F.col(text).alias("text"), number.alias("_text"))
    return _cut(docs, doc_id, text, _repeats(rows, length, most), as_text)


def remove_passages(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 51, length: int = 256, most: int = 50_000,
    as_text: bool = False,
) -> DataFrame:
    """As `remove_repeats` for strings of `words` words, however short, and for strings of `length` bytes.

    Words are what white space separates, and a window of words counts with the white space inside. `words` words
    have 2 * `words` - 1 bytes or more, so whatever repeats is inside the strings that windows of so many bytes
    give. These are few; in them the windows of words are counted, and the windows of `length` bytes are
    found as in documents. Shorter strings, of fewer words, stay.
    """
    key, number = _numbered(docs, doc_id, text)
    rows = docs.select(key.alias("id"), F.col(text).alias("text"), number.alias("_text"))
    within = written(_together(_repeats(rows, min(2 * words - 1, length), most)), "within")
    likely, _ = split_likely(rows, within.select("id"), "id")
    strings = written(likely.join(within, ["id", "_text"]).mapInArrow(*_string_rows(words, length)), "strings")

    windows = strings.select("id", "_text", "start", "body", "opens", "closes").mapInArrow(*_word_windows(words))
    windows = written(windows, "windows")
    twice = windows.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    passages = windows.join(twice, ["d1", "d2"], "left_semi").select("id", "_text", "start", "stop")

    # A string is a document of its own, told apart by its place as well.
    of = F.xxhash64("id", "start")
    long = strings.filter(F.octet_length("body") >= length).withColumns({"of": of, "of_text": F.xxhash64("_text", "start")})
    parts = long.select(F.col("of").alias("id"), F.col("body").alias("text"), F.col("of_text").alias("_text"))
    inside = _repeats(parts, length, most).select(
        F.col("id").alias("of"), F.col("_text").alias("of_text"), F.col("start").alias("a"), F.col("stop").alias("b")
    )
    places = long.select("of", "of_text", "id", "_text", "start").distinct()
    bytes_ = inside.join(places, ["of", "of_text"]).select(
        "id", "_text", (F.col("start") + F.col("a")).alias("at"), (F.col("start") + F.col("b")).alias("stop")
    ).withColumnRenamed("at", "start")
    return _cut(docs, doc_id, text, passages.unionByName(bytes_), as_text)
