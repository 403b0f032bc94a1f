"""Merging the bytes of many words at once by the ranks of a BPE vocabulary."""

from __future__ import annotations

import numpy as np

NO_RANK = 1 << 40


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    hidden = [b for b in range(256) if b not in set(plain)]
    return letters | {chr(256 + i): b for i, b in enumerate(hidden)}


class Merges:
    """The merge table. In every round each word joins its pair of lowest rank wherever that
    occurs, from left to right, until no word has a pair left."""

    def __init__(self, vocab: dict[str, int], merges: list) -> None:
        pairs, joined = [], []
        for merge in merges:
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pairs.append((vocab[left] << 32) | vocab[right])
            joined.append(vocab[left + right])
        self.joined = np.array(joined, np.int64)  # by rank
        # Ranks by pair, a hash table with open addressing that is at most a quarter full.
        self.bits = max(4, (4 * len(pairs)).bit_length())
        self.table_pair = np.full(1 << self.bits, -1, np.int64)
        self.table_rank = np.full(1 << self.bits, NO_RANK, np.int64)
        todo, slot = np.arange(len(pairs)), self._slots(np.array(pairs, np.int64))
        keys = np.array(pairs, np.int64)
        while len(todo):
            free = self.table_pair[slot] == -1
            self.table_pair[slot[free]] = keys[todo[free]]  # of several for one slot the last stays
            won = self.table_pair[slot] == keys[todo]
            self.table_rank[slot[won]] = todo[won]
            todo, slot = todo[~won], (slot[~won] + 1) & ((1 << self.bits) - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def _ranks(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slots(keys)
        ranks = np.full(len(keys), NO_RANK, np.int64)
        todo = np.arange(len(keys))
        while len(todo):
            held = self.table_pair[slot]
            hit = held == keys[todo]
            ranks[todo[hit]] = self.table_rank[slot[hit]]
            more = ~hit & (held != -1)
            todo, slot = todo[more], (slot[more] + 1) & ((1 << self.bits) - 1)
        return ranks

    def __call__(self, ids: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        """The ids of each word, 4 bytes each, from those of its bytes."""
        owner = np.repeat(np.arange(len(sizes)), sizes)
        done_ids, done_owner = [], []
        while len(ids):
            ranks = np.full(len(ids), NO_RANK, np.int64)
            inside = np.flatnonzero(owner[1:] == owner[:-1])
            ranks[inside] = self._ranks((ids[inside] << 32) | ids[inside + 1])
            starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            lengths = np.diff(np.concatenate([starts, [len(ids)]]))
            lowest = np.repeat(np.minimum.reduceat(ranks, starts), lengths)
            ended = lowest == NO_RANK
            done_ids.append(ids[ended])
            done_owner.append(owner[ended])
            at = np.flatnonzero((ranks == lowest) & ~ended)
            # Of neighbours in a run of one pair (as in "aaa") every second one is joined.
            first = np.concatenate([[True], np.diff(at) != 1])[: len(at)]
            run = at[np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))] if len(at) else at
            at = at[(at - run) % 2 == 0]
            ids[at] = self.joined[ranks[at]]
            keep = ~ended
            keep[at + 1] = False
            ids, owner = ids[keep], owner[keep]
        if not done_ids:
            return [b""] * len(sizes)
        owner = np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        flat = np.concatenate(done_ids)[order].astype("<i4").tobytes()
        ends = np.cumsum(np.bincount(owner, minlength=len(sizes))).tolist()
        return [flat[4 * a : 4 * b] for a, b in zip([0, *ends], ends)]
