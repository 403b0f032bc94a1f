"""Periodic runs of words in texts, found by convolving blocks at dyadic scales.

A run is a stretch of words with smallest period q (words q apart are the same) that holds at
least `least` words and `times` periods, and that no neighbouring word extends.

Scale b = 1, 2, 4, ... looks for the periods from b to 2b - 1. The words are cut into aligned
blocks of b words; for every block the squared differences to the words d places on, for all
those d at once, are one convolution, done exactly by a number-theoretic transform. Shifts
without a mismatch that two or more blocks in a row share are seeds: a run of at least four
periods holds such blocks, all but fewer than b of its words at either end. Comparing the words
around a seed gives the whole run.

Two exact screens come before a transform: a block of a run has each of its words again within
2b - 1 words, and a block whose whole window lies in a run of a smaller period has no other
primitive period. Words are reduced to few codes so that sums stay below the prime; the
comparison of the words themselves decides.

Defined results: words are what is between the bytes 0x20 and 0x09 to 0x0D. Null and empty texts
have no words, no runs and an empty collapsed text. Every row is a document of its own, repeated
or not, and null ids pass through. Other columns pass through; clashing `n_words`, `runs`,
`strongest` and `collapsed` are replaced. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mobility_lake.llm.common import by_bytes

PRIME = 2013265921  # 15 * 2**27 + 1
ROOT = 31  # generates all residues but 0
DIRECT = 8  # blocks up to here are compared word by word
CELLS = 1 << 20  # of one transform
BATCH = 4 << 20  # bytes of text at a time

RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
RUN_ARROW = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])
RESULT = ["n_words", "runs", "strongest", "collapsed"]


def _powers(base: int, count: int) -> np.ndarray:
    """base ** 0, 1, ... modulo the prime, by doubling; `count` is a power of two."""
    out = np.ones(1, np.uint64)
    while len(out) < count:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), PRIME)) % np.uint64(PRIME)])
    return out


class Transform:
    """The transform of rows of `size` numbers; the forward order of values is bit-reversed."""

    def __init__(self, size: int) -> None:
        root = pow(ROOT, (PRIME - 1) // size, PRIME)
        self.forward_powers = _powers(root, max(1, size // 2))
        self.inverse_powers = _powers(pow(root, -1, PRIME), max(1, size // 2))
        self.scale = np.uint64(pow(size, -1, PRIME))

    def forward(self, rows: np.ndarray) -> np.ndarray:
        count, size = rows.shape
        prime, half, step = np.uint64(PRIME), size // 2, 1
        while half:
            pairs = rows.reshape(count, -1, 2, half)
            left, right = pairs[:, :, 0], pairs[:, :, 1]
            joined = left + right
            apart = (left + (prime - right)) * self.forward_powers[::step] % prime
            pairs[:, :, 0] = np.where(joined >= prime, joined - prime, joined)
            pairs[:, :, 1] = apart
            half, step = half // 2, step * 2
        return rows

    def inverse(self, rows: np.ndarray) -> np.ndarray:
        count, size = rows.shape
        prime, half = np.uint64(PRIME), 1
        while half < size:
            pairs = rows.reshape(count, -1, 2, half)
            left = pairs[:, :, 0].copy()
            right = pairs[:, :, 1] * self.inverse_powers[:: size // (2 * half)] % prime
            joined = left + right
            pairs[:, :, 0] = np.where(joined >= prime, joined - prime, joined)
            apart = left + (prime - right)
            pairs[:, :, 1] = np.where(apart >= prime, apart - prime, apart)
            half *= 2
        rows *= self.scale
        rows %= prime
        return rows


def mismatches(codes: np.ndarray, starts: np.ndarray, block: int) -> np.ndarray:
    """Summed squared differences of each block with the words block, ..., 2 * block - 1 places on.

    `codes` go on for 3 * block entries behind the last start, and block times the square of the
    largest code is below the prime, so the sums are exact.
    """
    window = np.lib.stride_tricks.sliding_window_view(codes, 2 * block - 1)[starts + block].astype(np.uint64)
    words = np.lib.stride_tricks.sliding_window_view(codes, block)[starts].astype(np.uint64)
    squares = np.cumsum(np.pad(window * window, ((0, 0), (1, 0))), axis=1)
    both = (words * words).sum(axis=1, keepdims=True) + squares[:, block:] - squares[:, :-block]
    transform = Transform(2 * block)
    # Entry block - 1 + j of the product with the reversed block is the sum for shift block + j; a
    # transform of twice the block wraps around behind and before those entries only.
    left = transform.forward(np.pad(window, ((0, 0), (0, 1))))
    left *= transform.forward(np.pad(words[:, ::-1], ((0, 0), (0, block))))
    left %= np.uint64(PRIME)
    products = transform.inverse(left)[:, block - 1 : 2 * block - 1]
    return both.astype(np.int64) - 2 * products.astype(np.int64)


def _hits(ids: np.ndarray, starts: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """(block start, shift) of all blocks that come again `shift` words on."""
    if block <= DIRECT:
        found = [(starts, np.full(len(starts), d)) for d in range(block, 2 * block)]
        for at in range(block):
            found = [(s[same], d[same]) for s, d in found for same in [ids[s + at] == ids[s + at + d]]]
        return np.concatenate([s for s, _ in found]), np.concatenate([d for _, d in found])
    few = int((PRIME // block) ** 0.5)
    codes = ids % few
    each = max(1, CELLS // (2 * block))
    found = [np.zeros((2, 0), np.int64)]
    for first in range(0, len(starts), each):
        own = starts[first : first + each]
        row, shift = np.nonzero(mismatches(codes, own, block) == 0)
        found.append(np.stack([own[row], shift + block]))
    both = np.concatenate(found, axis=1)
    return both[0], both[1]


def find(ids: np.ndarray, ends: np.ndarray, least: int, times: int) -> list[tuple[int, int, int]]:
    """(start, end, period) of the runs in texts whose word ids stand one after the other."""
    total = len(ids)
    begins = np.concatenate([[0], ends[:-1]])
    longest = int((ends - begins).max(initial=0))
    never = np.int64(1 << 40)
    again = np.full(total, never)  # places to the next occurrence of a word in its text
    order = np.argsort(ids, kind="stable")
    text = np.repeat(np.arange(len(ends)), ends - begins)
    same = (ids[order[1:]] == ids[order[:-1]]) & (text[order[1:]] == text[order[:-1]])
    again[order[:-1][same]] = (order[1:] - order[:-1])[same]
    runs: dict[tuple[int, int], int] = {}
    block = 1
    while block * times <= longest:
        if block > 1:  # the largest distance in each block, from those of its halves
            again = np.pad(again, (0, len(again) % 2), constant_values=never).reshape(-1, 2).max(axis=1)
        starts = np.flatnonzero(again < 2 * block) * block
        if len(starts):
            known = np.array(sorted(runs), np.int64).reshape(-1, 2)
            reach = np.maximum.accumulate(np.concatenate([[-1], known[:, 1]]))
            starts = starts[reach[np.searchsorted(known[:, 0], starts, side="right")] < starts + 3 * block - 1]
        if len(starts):
            padded = np.concatenate([ids, np.zeros(3 * block, ids.dtype)])
            for start, stop, shift in _seeds(*_hits(padded, starts, block), block):
                own = int(np.searchsorted(ends, start, side="right"))
                low, high = max(int(begins[own]), start - block), min(int(ends[own]) - shift, stop + block)
                other = np.flatnonzero(ids[low:high] != ids[low + shift : high + shift]) + low
                edges = np.concatenate([[low - 1], other, [max(low, high)]])
                for at in np.flatnonzero(np.diff(edges) - 1 >= max(least, times * shift) - shift):
                    run = (int(edges[at]) + 1, int(edges[at + 1]) + shift)
                    runs[run] = min(shift, runs.get(run, shift))
        block *= 2
    return sorted((start, end, period) for (start, end), period in runs.items())


def _seeds(starts: np.ndarray, shifts: np.ndarray, block: int) -> Iterator[tuple[int, int, int]]:
    """(start, end, shift) of two or more blocks in a row that come again after one shift."""
    order = np.lexsort((starts, shifts))
    starts, shifts = starts[order], shifts[order]
    if not len(starts):
        return
    broken = np.flatnonzero((np.diff(starts) != block) | (np.diff(shifts) != 0))
    first, last = np.concatenate([[0], broken + 1]), np.concatenate([broken, [len(starts) - 1]])
    on = last > first
    yield from zip(starts[first[on]].tolist(), (starts[last[on]] + block).tolist(), shifts[first[on]].tolist())


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """Of (start, length, period) the one with the greatest length / period, the first of equals."""
    bits = 2 * max((length.bit_length() for _, length, _ in runs), default=0)  # tells all fractions apart
    return max(runs, key=lambda r: ((r[1] << bits) // r[2], -r[0], -r[2]), default=None)


def _of_batch(values: pa.Array, least: int, times: int) -> dict[str, pa.Array]:
    words = [text.split() for text in values.fill_null("").cast(pa.binary()).to_pylist()]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes)
    flat = pa.array([w for own in words for w in own], pa.binary())
    ids = flat.dictionary_encode().indices.to_numpy().astype(np.int64)
    found: list[list[tuple[int, int, int]]] = [[] for _ in words]
    keep = np.ones(len(ids), bool)
    runs = find(ids, ends, least, times) if len(ids) else []
    for (start, end, period), own in zip(runs, np.searchsorted(ends, [r[0] for r in runs], side="right").tolist()):
        keep[start + period : end] = False
        found[own].append((int(start - ends[own] + sizes[own]), end - start, period))
    collapsed = []
    for own, runs_of, end in zip(words, found, ends.tolist()):
        if runs_of:
            own = [w for w, k in zip(own, keep[end - len(own) : end].tolist()) if k]
        collapsed.append(b" ".join(own))
    named = [[dict(zip(("start", "length", "period"), r)) for r in own] for own in found]
    top = [best and dict(zip(("start", "length", "period"), best)) for best in map(strongest, found)]
    return {
        "n_words": pa.array(sizes),
        "runs": pa.array(named, pa.list_(RUN_ARROW)),
        "strongest": pa.array(top, RUN_ARROW),
        "collapsed": pa.array(collapsed, pa.binary()),
    }


def find_runs(docs: DataFrame, text: str = "text", least: int = 6, times: int = 4) -> DataFrame:
    """`docs` with `n_words`, the `runs` (start, length and period in words, by start, then period),
    the `strongest` of them (greatest length / period, the first of equals; null without a run) and
    `collapsed`: the words that no run holds behind its first period, with single blanks.

    Each text is worked whole within the task that reads it; nothing is shuffled.
    """
    if times < 4 or least < 1:
        raise ValueError("runs of four periods or more are found")
    kept = [c for c in docs.columns if c not in RESULT]
    kinds = [T.LongType(), T.ArrayType(RUN), RUN, T.BinaryType()]
    out = T.StructType([docs.schema[c] for c in kept] + [T.StructField(n, k) for n, k in zip(RESULT, kinds)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, text, BATCH):
            found = _of_batch(batch.column(text), least, times)
            yield pa.record_batch([*(batch.column(c) for c in kept), *found.values()], names=[*kept, *found])

    found = docs.select(*dict.fromkeys([*kept, text])).mapInArrow(run, out)
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))
