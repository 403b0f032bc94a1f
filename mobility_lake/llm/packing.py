"""Packing token pieces into sequences of a fixed capacity.

Documents become token ids, end with an end id, and only those longer than a sequence are cut
into pieces of one sequence each, the last one shorter. Pieces are dealt at random into groups
of about `group_rows`; a group is packed in one task, so no task or driver sees all pieces,
and each group leaves a handful of underfull sequences at most.

Within a group best fit, longest first, gives a start. Then local search empties sequences: a
piece of the least filled one moves into a gap, or is exchanged for one or two smaller pieces
of an underfull sequence, or two of its pieces for one; whatever step fills the other sequence
most. Every step raises the sum of squared fills. The search ends when the group's tokens
cannot fit into fewer sequences or no step is left.

Defined results: null and empty texts are the end id alone. Repeated documents are packed as
often as they occur; null ids pass through. An empty table gives no pieces. Of the input only
the id and text columns are used, so other columns may have any name.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mobility_lake.llm.common import by_bytes, gathered, spliced, written
from mobility_lake.llm.merges import Merges, byte_letters

CACHED_WORDS = 150_000  # in each of two generations
LONG_WORD = 256
# Texts of Latin letters only have one lower case, before and after normalising.
PLAIN_WORD = r"^[a-z\x{df}-\x{f6}\x{f8}-\x{ff}]+$"
# The same letters with a mark behind: others may end in a combining mark when they are lower-cased or
# normalised, and the library makes that and the comma or stop one token.
STOPPED = r"^[a-z\x{df}-\x{f6}\x{f8}-\x{ff}]+[,.]$"
NOT_PLAIN = r"[^\x00-\x{12f}\x{131}-\x{24f}]|<\|"
BATCH = 16 << 20  # bytes of text at a time


class WordTokenizer:
    """Ids of a `tokenizers` file that lower-cases and whose tokens hold no white space.

    Such a text has the ids of its words one after the other, so each new word is encoded
    once; two generations of words are kept per worker.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

        self._read_merges(path)

    def _read_merges(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        letters, vocab, end = byte_letters(), model["vocab"], model.get("end_of_word_suffix") or ""
        self.merges = Merges(vocab, model["merges"])
        self.inner, self.last = np.zeros(256, np.int64), np.zeros(256, np.int64)
        for letter, byte in letters.items():
            self.inner[byte], self.last[byte] = vocab[letter], vocab[letter + end]

    def _encode(self, words: list[str]) -> list[bytes]:
        """Words of plain letters are one token run each and are merged together; the library does the rest."""
        plain = np.asarray(pc.match_substring_regex(pa.array(words, pa.string()), PLAIN_WORD), dtype=bool)
        out: list[bytes] = [b""] * len(words)
        rest = np.flatnonzero(~plain).tolist()
        found = self.tokenizer.encode_batch([words[i] for i in rest], add_special_tokens=False)
        for i, encoding in zip(rest, found):
            out[i] = np.array(encoding.ids, "<u4").tobytes()
        at = np.flatnonzero(plain).tolist()
        raw = [words[i].encode() for i in at]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        letters = np.frombuffer(b"".join(raw), np.uint8)
        ids = self.inner[letters]
        ends = np.cumsum(sizes) - 1
        ids[ends] = self.last[letters[ends]]
        for i, merged in zip(at, self.merges(ids, sizes)):
            out[i] = merged
        return out

    def __call__(self, values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text begins and ends in it."""
        values = pc.fill_null(values, "")
        # Lower case where that saves work; special tokens are read before lower-casing.
        as_is = pc.match_substring_regex(values, NOT_PLAIN)
        cut = pc.ascii_split_whitespace(pc.if_else(as_is, values, pc.utf8_lower(values)))
        distinct = cut.flatten().dictionary_encode()
        # Letters with a stop or comma behind: the mark is a token of its own.
        stopped = pc.match_substring_regex(distinct.dictionary, STOPPED)
        bodies = pc.utf8_slice_codeunits(distinct.dictionary, 0, -1).filter(stopped).to_pylist()
        marks = pc.utf8_slice_codeunits(distinct.dictionary, -1).filter(stopped).to_pylist()
        others = distinct.dictionary.filter(pc.invert(stopped)).to_pylist()
        recent, older = self.recent, self.older
        words = {*others, *bodies, ",", "."}
        missing = words.difference(recent)
        if len(recent) + len(missing) > CACHED_WORDS:
            older, recent = self.older, self.recent = recent, {}
            missing = words
        if older:
            recent.update([(w, older[w]) for w in missing.intersection(older)])
        fresh = list(missing.difference(older))
        recent.update(zip(fresh, self._encode(fresh)))
        parts = list(map(recent.__getitem__, others))
        parts += [recent[body] + recent[mark] for body, mark in zip(bodies, marks)]
        for word in fresh:
            if len(word) > LONG_WORD:
                del recent[word]
        mask = np.asarray(stopped)
        place = np.where(mask, len(others) + np.cumsum(mask) - 1, np.cumsum(~mask) - 1)
        index = place[distinct.indices.to_numpy()]
        return spliced(parts, index, np.asarray(cut.offsets) - cut.offsets[0].as_py())


_TOKENIZERS: dict[str, WordTokenizer] = {}


def _tokenizer(path: str) -> WordTokenizer:
    """One per worker process."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def cut_documents(
    docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", capacity: int = 2048, end_id: int = 0,
    with_ids: bool = False,
) -> DataFrame:
    """A row per piece: the id column, `piece`, `start`, `length`, `ids_crc32`, and `ids` if asked for."""
    kind = dict(docs.select(doc_id).dtypes)[doc_id]
    schema = f"{doc_id} {kind}, piece int, start long, length long, ids_crc32 long"
    schema += ", ids array<int>" if with_ids else ""
    names = [doc_id, "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _tokenizer(path)
        # Large batches: each distinct word of one is looked up once.
        # Ids that go out with their pieces need room beside them.
        most = BATCH // 8 if with_ids else BATCH
        for batch in by_bytes(gathered(batches, text, most // 2), text, most):
            owner, piece, start, length, crc, ids = [], [], [], [], [], []
            flat, ends = encode(batch.column(text))
            raw, ends = flat.tobytes(), (4 * ends).tolist()
            for at in range(batch.num_rows):
                tokens = raw[ends[at] : ends[at + 1]] + end
                for number, place in enumerate(range(0, len(tokens), 4 * capacity)):
                    part = tokens[place : place + 4 * capacity]
                    owner.append(at)
                    piece.append(number)
                    start.append(place // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4").astype("i4"))
            columns = [
                batch.column(doc_id).take(pa.array(owner, pa.int64())),
                pa.array(piece, pa.int32()),
                *(pa.array(x, pa.int64()) for x in (start, length, crc)),
            ]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
            yield pa.record_batch(columns, names=names)

    return docs.select(doc_id, text).mapInArrow(run, schema)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of positions: longest first, each into the fullest bin that takes it."""
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: some bin has exactly r left
    bins: list[list[int]] = []
    for at in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        size = lengths[at]
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            number = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, number = capacity, len(bins)
            bins.append([])
        bins[number].append(at)
        room -= size
        if room:
            by_room[room].append(number)
            rooms |= 1 << room
    return bins


def empty_bins(bins: list[list[int]], lengths: list[int], capacity: int, steps: int) -> list[list[int]]:
    """Local search: exchange pieces until bins run empty; at most `steps` accepted exchanges."""
    fill = [sum(lengths[i] for i in b) for b in bins]
    least = -(-sum(fill) // capacity)
    underfull = {n for n, f in enumerate(fill) if f < capacity}
    alive = len(bins)
    stuck: set[int] = set()
    while alive > least and steps > 0 and len(underfull - stuck) > 1:
        giver = min(underfull - stuck, key=lambda n: (fill[n], n))
        step = _best_step(giver, underfull, bins, fill, lengths, capacity)
        if step is None:
            stuck.add(giver)
            continue
        steps -= 1
        taker, given, taken = step
        moved = sum(lengths[i] for i in given) - sum(lengths[i] for i in taken)
        bins[giver] = [i for i in bins[giver] if i not in given] + list(taken)
        bins[taker] = [i for i in bins[taker] if i not in taken] + list(given)
        fill[giver] -= moved
        fill[taker] += moved
        if fill[taker] == capacity:
            underfull.discard(taker)
        stuck.discard(taker)
        if not bins[giver]:
            underfull.discard(giver)
            alive -= 1
            stuck.clear()
    return [b for b in bins if b]


@functools.cache
def _pairs(size: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(size, 1)


def _two_of_each(held: list[int], lengths: list[int]) -> list[int]:
    """Pieces whose pairs have every sum that pairs of `held` have: two of a length stand for all of it."""
    times: dict[int, int] = {}
    out = []
    for i in held:
        times[lengths[i]] = times.get(lengths[i], 0) + 1
        if times[lengths[i]] <= 2:
            out.append(i)
    return out


def _best_step(giver, underfull, bins, fill, lengths, capacity):
    """(other bin, pieces given, pieces taken) that adds most to a bin at least as full, or None."""
    others = [n for n in underfull if n != giver and fill[n] >= fill[giver]]
    if not others:
        return None
    room = np.array([capacity - fill[n] for n in others])
    own = sorted(bins[giver], key=lambda i: -lengths[i])
    sizes = np.array([lengths[i] for n in others for i in bins[n]])
    owner = np.repeat(np.arange(len(others)), [len(bins[n]) for n in others])
    pieces = [i for n in others for i in bins[n]]
    gain, best = 0, None
    for given in ([i] for i in own):
        size = lengths[given[0]]
        if size <= gain:
            break
        fits = np.flatnonzero(room >= size)  # a plain move: the fullest bin that takes it
        if len(fits):
            at = int(fits[room[fits].argmin()])
            gain, best = size, (others[at], tuple(given), ())
            break
    # One or two of ours for one of theirs.
    ours = [(i,) for i in own] + list(itertools.combinations(_two_of_each(own, lengths), 2))
    for given in ours:
        size = sum(lengths[i] for i in given)
        more = size - sizes
        allowed = np.where((more > gain) & (more <= room[owner]), more, 0)
        at = int(allowed.argmax())
        if allowed[at] > gain:
            gain, best = int(allowed[at]), (others[owner[at]], given, (pieces[at],))
    # One of ours for two of theirs.
    for at, n in enumerate(others):
        theirs = _two_of_each(sorted(bins[n], key=lambda i: lengths[i]), lengths)
        if len(theirs) < 2 or room[at] <= gain:
            continue
        left, right = _pairs(len(theirs))
        small = np.array([lengths[i] for i in theirs])
        both = small[left] + small[right]
        for mine in own:
            more = lengths[mine] - both
            allowed = np.where((more > gain) & (more <= room[at]), more, 0)
            k = int(allowed.argmax())
            if allowed[k] > gain:
                gain, best = int(allowed[k]), (n, (mine,), (theirs[left[k]], theirs[right[k]]))
    return best


def pack(
    pieces: DataFrame, length: str = "length", capacity: int = 2048, group_rows: int = 20_000, steps: int = 2_000
) -> DataFrame:
    """`pieces` with `sequence_id` and `offset`; columns so named are replaced.

    `steps` bounds the exchanges of one group's search, hence its time; every piece is placed
    whatever it is.
    """
    pieces = written(pieces.drop("sequence_id", "offset"), "pieces")
    groups = max(1, -(-pieces.count() // group_rows))
    # The number of a row in a written table is the same whenever it is read.
    dealt = pieces.withColumn("_row", F.monotonically_increasing_id())
    dealt = dealt.withColumn("_group", F.pmod(F.xxhash64("_row"), F.lit(groups)))

    def run(key, group):
        group = group.sort_values("_row", ignore_index=True)
        lengths = group[length].tolist()
        bins = empty_bins(best_fit(lengths, capacity), lengths, capacity, steps)
        sequence, offset = np.zeros(len(group), np.int64), np.zeros(len(group), np.int64)
        for number, held in enumerate(bins):
            at = 0
            for i in held:
                sequence[i], offset[i] = (int(key[0]) << 32) | number, at
                at += lengths[i]
        return pd.DataFrame({"_row": group["_row"], "sequence_id": sequence, "offset": offset})

    # Only numbers and lengths travel to the packing; the pieces join their places after it.
    narrow = dealt.select("_group", "_row", length)
    places = narrow.groupBy("_group").applyInPandas(run, "_row long, sequence_id long, offset long")
    return dealt.drop("_group").join(places, "_row").drop("_row")
