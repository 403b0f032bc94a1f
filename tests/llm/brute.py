"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import collections
import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, words=5):
    found = WORD.findall((text or "").translate(LOWER))
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1)))


def near_components(ids, texts, percent=75):
    """{(id, shingles, component)} with every pair compared."""
    sets = [shingle_set(t) for t in texts]
    top = list(range(len(ids)))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            both, either = len(sets[i] & sets[j]), len(sets[i] | sets[j])
            if either and 100 * both >= percent * either:
                top[root(i)] = root(j)
    least = {}
    for i in range(len(ids)):
        least[root(i)] = min(least.get(root(i), ids[i]), ids[i])
    return sorted((ids[i], len(sets[i]), least[root(i)]) for i in range(len(ids)))


def without_repeats(texts, length):
    """For each text (spans, kept bytes)."""
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(t[i : i + length] for t in raw for i in range(len(t) - length + 1))
    out = []
    for t in raw:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = [(m.start(), m.end()) for m in re.finditer(b"\1+", bytes(gone))]
        out.append((spans, bytes(b for b, g in zip(t, gone) if not g)))
    return out


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()
