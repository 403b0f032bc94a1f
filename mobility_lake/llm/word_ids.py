"""Byte-level BPE ids of texts, with an arena of known words.

The distinct words of a batch are looked up in a dictionary that numbers them; their ids lie in
one array, so texts are put together by index. New words are merged together from their bytes.
Two generations of words bound the memory; the ids never depend on what is known.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from mobility_lake.llm.bpe import Vocabulary, cut_texts
from mobility_lake.llm.merges import NO_RANK, Merges

CACHED_WORDS = 250_000  # in each of two generations
# A word with a stop or comma behind it, which is a token of its own: no merge reaches over its end.
STOPPED = r"^[ \n]?\pL+[,.]$"
ONE_WORD = r"^ ?\pL+$"


def merge_words(merges: Merges, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words in a row, how many each word has), from the ids of their bytes.

    In every round each word joins its pair of lowest rank; only the pairs around a joined one
    are looked up anew.
    """
    owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    ids = ids.astype(np.int64)
    ranks = np.full(len(ids), NO_RANK, np.int64)
    inside = np.flatnonzero(owner[1:] == owner[:-1])
    ranks[inside] = merges._ranks((ids[inside] << 32) | ids[inside + 1])
    done_ids, done_owner = [], []
    while len(ids):
        starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        lengths = np.diff(np.concatenate([starts, [len(ids)]]))
        lowest = np.repeat(np.minimum.reduceat(ranks, starts), lengths)
        ended = lowest == NO_RANK
        done_ids.append(ids[ended])
        done_owner.append(owner[ended])
        at = np.flatnonzero((ranks == lowest) & ~ended)
        if not len(at):
            break
        # Of neighbours in a run of one pair (as in "aaa") every second one is joined.
        first = np.concatenate([[True], np.diff(at) != 1])
        run = at[np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))]
        at = at[(at - run) % 2 == 0]
        ids[at] = merges.joined[ranks[at]]
        keep = ~ended
        keep[at + 1] = False
        now = np.cumsum(keep)[at] - 1
        ids, owner, ranks = ids[keep], owner[keep], ranks[keep]
        around = np.zeros(len(ids) + 1, bool)
        around[now] = around[now - 1] = True  # the spare entry stands in for the one before the first
        changed = np.flatnonzero(around[:-1])
        ranks[changed] = NO_RANK
        changed = changed[changed + 1 < len(ids)]
        changed = changed[owner[changed] == owner[changed + 1]]
        ranks[changed] = merges._ranks((ids[changed] << 32) | ids[changed + 1])
    if not done_ids:
        return np.zeros(0, np.int32), np.zeros(len(sizes), np.int64)
    owner = np.concatenate(done_owner)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(done_ids)[order].astype(np.int32), np.bincount(owner, minlength=len(sizes))


class Arena:
    """Words by number, with their ids in a row."""

    def __init__(self) -> None:
        self.number: dict[str, int] = {}
        self.flat, self.ends = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def add(self, words: list[str], flat: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The numbers of new words."""
        base = len(self.ends) - 1
        self.number.update(zip(words, range(base, base + len(words))))
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(counts)])
        self.flat = np.concatenate([self.flat, flat])
        return np.arange(base, base + len(words))

    def find(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.number.get, words, repeat(-1)), np.int64, len(words))

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids in a row, how many each has) of words by number."""
        starts, counts = self.ends[numbers], self.ends[numbers + 1] - self.ends[numbers]
        ends = np.cumsum(counts)
        return self.flat[np.repeat(starts - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)], counts


def _bytes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all words in a row, and how many each has."""
    sizes = np.asarray(pc.binary_length(words), dtype=np.int64)
    raw = words.buffers()[2]
    first = np.frombuffer(words.buffers()[1], np.int32)[words.offset] if len(words) else 0
    return np.frombuffer(raw, np.uint8, int(sizes.sum()), int(first)) if raw else np.zeros(0, np.uint8), sizes


class WordIds:
    """Texts to ids of a byte-level BPE file of the `tokenizers` library."""

    def __init__(self, path: str) -> None:
        self.vocabulary = Vocabulary(path)
        self.recent, self.older = Arena(), Arena()

    def __call__(self, values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text begins and ends in it."""
        cut = cut_texts(values)
        distinct = cut.flatten().dictionary_encode()
        pieces = distinct.dictionary
        stopped = pc.match_substring_regex(pieces, STOPPED)
        bodies = pc.if_else(stopped, pc.utf8_slice_codeunits(pieces, 0, -1), pieces).dictionary_encode()
        numbers = self._numbers(bodies.dictionary)[bodies.indices.to_numpy()]
        # A mark is one id behind the ids of its word.
        mask = np.asarray(stopped, dtype=bool)
        single = self.vocabulary.single
        mark = np.where(np.asarray(pc.ends_with(pieces, ","), dtype=bool), single[ord(",")], single[ord(".")])
        flat, counts = self.recent.take(numbers)
        flat = np.insert(flat, np.cumsum(counts)[mask], mark[mask])
        counts = counts + mask
        ends = np.cumsum(counts)
        index = distinct.indices.to_numpy()
        each = counts[index]
        stops = np.cumsum(each)
        at = np.repeat((ends - counts)[index] - (stops - each), each) + np.arange(stops[-1] if len(stops) else 0)
        return flat[at], np.concatenate([[0], stops])[np.asarray(cut.offsets) - cut.offsets[0].as_py()]

    def _numbers(self, words: pa.Array) -> np.ndarray:
        """The number of each word; words not yet known are learned."""
        listed = words.to_numpy(zero_copy_only=False).tolist()
        if len(self.recent.number) + len(listed) > CACHED_WORDS:
            self.older, self.recent = self.recent, Arena()
        found = self.recent.find(listed)
        missing = np.flatnonzero(found < 0)
        if len(missing) and self.older.number:
            known = self.older.find([listed[i] for i in missing.tolist()])
            old = missing[known >= 0]
            found[old] = self.recent.add([listed[i] for i in old.tolist()], *self.older.take(known[known >= 0]))
            missing = missing[known < 0]
        if len(missing):
            found[missing] = self._learn(words.take(pa.array(missing)), [listed[i] for i in missing.tolist()])
        return found

    def _learn(self, words: pa.Array, listed: list[str]) -> np.ndarray:
        """Pieces of one word are merged as they are, the others word by word; returns their numbers."""
        vocabulary = self.vocabulary
        plain = pc.match_substring_regex(words, ONE_WORD)
        out, mask = np.zeros(len(listed), np.int64), np.asarray(plain, dtype=bool)
        raw, sizes = _bytes(words.filter(plain))
        merged = merge_words(vocabulary.merges, vocabulary.single[raw], sizes)
        out[mask] = self.recent.add([listed[i] for i in np.flatnonzero(mask).tolist()], *merged)
        odd = np.flatnonzero(~mask).tolist()
        cuts = [vocabulary.cut(listed[i]) for i in odd]
        inside = list({w for own in cuts for w in own if isinstance(w, str)})
        raw, sizes = _bytes(pa.array(inside, pa.string()))
        flat, counts = merge_words(vocabulary.merges, vocabulary.single[raw], sizes)
        ends = np.cumsum(counts)
        ids: dict[str | int, np.ndarray] = {w: flat[e - c : e] for w, e, c in zip(inside, ends, counts)}
        ids.update((i, np.array([i], np.int32)) for i in vocabulary.added.values())
        lists = [np.concatenate([ids[w] for w in own]) if own else flat[:0] for own in cuts]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        out[~mask] = self.recent.add([listed[i] for i in odd], np.concatenate([flat[:0], *lists]), sizes)
        return out
