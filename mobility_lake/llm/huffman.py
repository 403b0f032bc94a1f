"""Canonical Huffman codes of limited length, and bit streams with checkpoints.

Lengths come from counts by package-merge, the best code among those no longer than the limit.
Codes are canonical: they follow from the lengths alone, by rising length, then id. A stream
keeps the bit offset of every `every`-th id, so pieces can be decoded apart; a decoder advances
all pieces at once, one table look-up per id.
"""

from __future__ import annotations

import numpy as np

SHORTEST_LIMIT = 18  # bits; the decoding table has two to this power entries


def limit_for(symbols: int) -> int:
    """Longest code for so many symbols: room for all and two bits to tell frequent from rare."""
    return max(SHORTEST_LIMIT, max(1, symbols - 1).bit_length() + 2)


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Bits of each symbol's code; all counts are positive."""
    total = len(counts)
    if total < 2:
        return np.ones(total, np.int64)
    if total > 1 << limit:
        raise ValueError("more symbols than codes of that length")
    order = np.argsort(counts, kind="stable")
    single = np.asarray(counts, np.int64)[order]
    packages, levels = single[:0], []
    for _ in range(limit):
        both = np.concatenate([single, packages])
        by_weight = np.argsort(both, kind="stable")
        levels.append(by_weight < total)
        both = both[by_weight][: len(both) // 2 * 2]
        packages = both[::2] + both[1::2]
    lengths, taken = np.zeros(total, np.int64), 2 * total - 2
    for own in reversed(levels):
        symbols = int(own[:taken].sum())
        lengths[order[:symbols]] += 1
        taken = 2 * (taken - symbols)
    return lengths


class Code:
    """The canonical code of `ids` (rising) with these lengths."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        self.limit = int(lengths.max(initial=1))
        order = np.lexsort((ids, lengths))
        self.ids, self.sizes = np.asarray(ids, np.int64)[order], np.asarray(lengths, np.int64)[order]
        # Codes as numbers of `limit` bits, filled up with zeros: each starts where the one before ends.
        spans = np.int64(1) << (self.limit - self.sizes)
        self.firsts = np.cumsum(spans) - spans

    def encoder(self) -> tuple[np.ndarray, np.ndarray]:
        """(code, bits) by id."""
        codes = np.zeros(int(self.ids.max(initial=-1)) + 1, np.uint64)
        bits = np.zeros(len(codes), np.int64)
        codes[self.ids] = (self.firsts >> (self.limit - self.sizes)).astype(np.uint64)
        bits[self.ids] = self.sizes
        return codes, bits

    def table(self) -> np.ndarray:
        """By the next `limit` bits: id * 64 + bits of its code."""
        spans = np.int64(1) << (self.limit - self.sizes)
        full = np.repeat(self.ids * 64 + self.sizes, spans)
        return np.pad(full, (0, (1 << self.limit) - len(full)))


def pack(ids: np.ndarray, codes: np.ndarray, bits: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The bit stream of `ids`, most significant bit first, and the bit offset of each id."""
    if not len(ids):
        return b"", np.zeros(0, np.int64)
    sizes = bits[ids]
    ends = np.cumsum(sizes)
    offsets = ends - sizes
    own = codes[ids]
    word = offsets >> 6
    left = 64 - (offsets & 63) - sizes  # bits free behind the code in its word, below 0 if it runs over
    over = np.flatnonzero(left < 0)
    inside = np.where(left >= 0, own << np.maximum(left, 0).astype(np.uint64), own >> np.maximum(-left, 0).astype(np.uint64))
    # Every word but perhaps the last has a code that starts in it, as codes are shorter than a word.
    firsts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    out = np.zeros(int(ends[-1] + 63 >> 6), np.uint64)
    out[word[firsts]] = np.bitwise_or.reduceat(inside, firsts)
    out[word[over] + 1] |= own[over] << (64 + left[over]).astype(np.uint64)
    return out.astype(">u8").tobytes()[: int(ends[-1] + 7 >> 3)], offsets


def unpack(words: np.ndarray, offsets: np.ndarray, counts: np.ndarray, table: np.ndarray, limit: int) -> np.ndarray:
    """The ids of pieces that start at bit `offsets` and hold `counts` ids each, piece after piece.

    `words` are the 64-bit words of the stream with one more behind the last.
    """
    by_size = np.argsort(-counts, kind="stable")
    at, sizes = offsets[by_size].astype(np.int64), counts[by_size]
    place = (np.cumsum(counts) - counts)[by_size]
    out = np.empty(int(counts.sum()), np.int32)
    steps = int(sizes[0]) if len(sizes) else 0
    # How many pieces hold more than `step` ids.
    active = np.searchsorted(-sizes, -np.arange(steps), side="left")
    one, low, high = np.uint64(1), np.uint64(63), np.uint64(64 - limit)
    for step, many in enumerate(active.tolist()):
        now = at[:many]
        word, used = now >> 6, (now & 63).astype(np.uint64)
        window = (words[word] << used) | ((words[word + 1] >> one) >> (low - used))
        entry = table[(window >> high).astype(np.int64)]
        out[place[:many] + step] = entry >> 6
        now += entry & 63
    return out
