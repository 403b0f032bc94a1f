"""A minimal acyclic transducer from words to token ids, in one file that workers memory-map.

Words are added in byte order and equal suffixes share their states, so the automaton is the
smallest one that accepts the list. Every arc carries how many words sort before the ones
behind it; the sum along a word's path is its rank, which points at its ids.

Lookups take a whole list of words and advance all of them by one byte at a time.

File: six 8-byte counts, then 8-byte arc keys (state * 256 + label, rising), and as 4-byte
integers `target`, `skipped` (words before an arc), `final`, `ids_first` and `ids`.
"""

from __future__ import annotations

import mmap
import struct
from array import array
from collections.abc import Iterable

import numpy as np

HEAD = struct.Struct("<6q")


def compile_lexicon(words: Iterable[tuple[bytes, list[int]]]) -> bytes:
    """The file for distinct words with their ids."""
    entries = sorted(words)
    register: dict[tuple, int] = {}
    states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []

    def settle(final: bool, arcs: list[tuple[int, int]]) -> int:
        key = (final, tuple(arcs))
        number = register.get(key)
        if number is None:
            number = register[key] = len(states)
            states.append(key)
        return number

    # The path of the last word, not yet settled: [is final, settled arcs, label to the next].
    path: list[list] = [[False, [], -1]]
    before = b""
    for word, _ in entries:
        shared = 0
        for a, b in zip(word, before):
            if a != b:
                break
            shared += 1
        _fold(path, shared, settle)
        for label in word[shared:]:
            path[-1][2] = label
            path.append([False, [], -1])
        path[-1][0] = True
        before = word
    _fold(path, 0, settle)
    root = settle(path[0][0], path[0][1])

    accepted = [0] * len(states)  # a state's targets come before it
    keys, target, skipped = array("q"), array("i"), array("i")
    for number, (final, arcs) in enumerate(states):
        count = int(final)
        for label, to in arcs:
            keys.append(number * 256 + label)
            target.append(to)
            skipped.append(count)
            count += accepted[to]
        accepted[number] = count
    ids_first, ids = array("i", [0]), array("i")
    for _, tokens in entries:
        ids.extend(tokens)
        ids_first.append(len(ids))
    finals = array("i", [int(final) for final, _ in states])
    head = HEAD.pack(root, len(states), len(target), len(entries), len(ids), 0)
    return head + b"".join(a.tobytes() for a in (keys, target, skipped, finals, ids_first, ids))


def _fold(path: list[list], depth: int, settle) -> None:
    """Settle the states of the path below `depth`."""
    while len(path) > depth + 1:
        final, arcs, _ = path.pop()
        parent = path[-1]
        parent[1].append((parent[2], settle(final, arcs)))


class Lexicon:
    """Look words up in a memory-mapped file."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as file:
            self._map = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        self.root, self.states, arcs, self.words, ids, _ = HEAD.unpack_from(self._map)
        at = HEAD.size
        self._keys = np.frombuffer(self._map, "<i8", arcs, at)
        at += 8 * arcs
        parts = []
        for count in (arcs, arcs, self.states, self.words + 1, ids):
            parts.append(np.frombuffer(self._map, "<i4", count, at))
            at += 4 * count
        self._ids_at = at - 4 * ids
        self._target, self._skipped, self._final, self._ids_first, _ = parts

    def ranks(self, words: list[bytes]) -> np.ndarray:
        """The rank of each word in the list, -1 for a word that is not in it."""
        letters = np.frombuffer(b"".join(words), np.uint8)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.cumsum(sizes) - sizes
        out = np.full(len(words), -1, np.int64)
        active = np.arange(len(words))
        state = np.full(len(words), self.root, np.int64)
        rank = np.zeros(len(words), np.int64)
        depth = 0
        while len(active):
            ended = sizes[active] == depth
            accepted = ended & (self._final[state] == 1)
            out[active[accepted]] = rank[accepted]
            on = ~ended
            active, state, rank = active[on], state[on], rank[on]
            if not len(active) or not len(self._keys):
                break
            key = state * 256 + letters[starts[active] + depth]
            arc = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
            on = self._keys[arc] == key
            arc, active, rank = arc[on], active[on], rank[on]
            state, rank = self._target[arc].astype(np.int64), rank + self._skipped[arc]
            depth += 1
        return out

    def ids(self, ranks: np.ndarray) -> list[bytes]:
        """The ids of the words of these ranks, 4 bytes each."""
        starts = (self._ids_at + 4 * self._ids_first[ranks].astype(np.int64)).tolist()
        stops = (self._ids_at + 4 * self._ids_first[ranks + 1].astype(np.int64)).tolist()
        return [self._map[a:b] for a, b in zip(starts, stops)]
