"""Byte-level BPE with a transducer lexicon for frequent words.

The words of all texts, with the white space before them, are counted, the most frequent ones
(`max_words` at most) are compiled with their ids into a minimal acyclic transducer
(`lexicon.py`), and the file goes to every executor, where workers memory-map it. A word found
there costs one walk; any other is merged from its bytes by the ranks of the vocabulary. The
result never depends on what is in the lexicon. New words of a batch are looked up and merged
together, all of them by one step at a time; a bounded cache per worker keeps their ids.

A tokenizer file is read as it is (JSON of the `tokenizers` library): vocabulary, merges,
added tokens; the path is a parameter. Truncation, padding and prefix spaces are not
supported and raise.

Null and empty texts have no ids. Columns of the input pass through; a clashing `ids` is
replaced. Repeated rows give repeated results; an empty table gives an empty table.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mobility_lake.llm.common import by_bytes, shared_file, spliced, written
from mobility_lake.llm.lexicon import Lexicon, compile_lexicon
from mobility_lake.llm.merges import Merges, byte_letters

# How byte-level BPE cuts a text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Runs of white space with what follows. No word of WORDS reaches over the end of such a piece
# as long as all white space is of these six kinds; other texts are cut by WORDS alone.
PIECES = re.compile(r"[ \t\n\r\x0b\x0c]*[^ \t\n\r\x0b\x0c]+|[ \t\n\r\x0b\x0c]+")
OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
# White space other than single blanks and line ends, or the letter used as a mark below.
RARE = "[\t\r\x0b\x0c\x01\x1c-\x1f\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]|[ \n][ \n]"
CACHED_PIECES = 100_000  # in each of two generations
LONG_PIECE = 256
BATCH = 4 << 20  # bytes of text at a time


def cut_texts(values: pa.Array) -> pa.ListArray:
    """Each text cut where white space begins."""
    values = pc.fill_null(values, "")
    rare = pc.match_substring_regex(values, RARE)
    if not pc.any(rare).as_py():
        # Marking and splitting is many times faster than a regular expression.
        marked = pc.replace_substring(pc.replace_substring(values, " ", "\x01 "), "\n", "\x01\n")
        return pc.split_pattern(marked, "\x01")
    plain = cut_texts(values.filter(pc.invert(rare)))
    odd = [[t] if OTHER_SPACE.search(t) else PIECES.findall(t) for t in values.filter(rare).to_pylist()]
    both = pa.concat_arrays([plain, pa.array(odd, plain.type)])
    mask = np.asarray(rare)
    place = np.empty(len(values), np.int64)
    place[~mask] = np.arange(len(plain))
    place[mask] = np.arange(len(plain), len(values))
    return both.take(pa.array(place))


class Vocabulary:
    """Merge ranks and token bytes of a tokenizer file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        cutter = spec["pre_tokenizer"]
        if spec.get("normalizer") or cutter["type"] != "ByteLevel" or cutter["add_prefix_space"]:
            raise ValueError("a byte-level BPE tokenizer without normalizer and prefix space is needed")
        letters = byte_letters()
        vocab = spec["model"]["vocab"]
        self.token_bytes: dict[int, bytes] = {
            number: bytes(letters[c] for c in token) for token, number in vocab.items()
        }
        self.single = np.zeros(256, np.int64)
        for number, token in self.token_bytes.items():
            if len(token) == 1:
                self.single[token[0]] = number
        self.merges = Merges(vocab, spec["model"]["merges"])
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token_bytes.update((i, content.encode()) for content, i in self.added.items())
        longest_first = sorted(self.added, key=len, reverse=True)
        self.marks = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.added else None
        self.words = regex.compile(WORDS)

    def merge(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, 4 bytes each."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        return self.merges(self.single[np.frombuffer(b"".join(words), np.uint8)], sizes)

    def cut(self, text: str) -> list[str | int]:
        """Words of a text, and the ids of added tokens that stand in it."""
        if self.marks is None:
            return self.words.findall(text)
        found: list[str | int] = []
        for at, part in enumerate(self.marks.split(text)):
            if at % 2:
                found.append(self.added[part])
            elif part:
                found.extend(self.words.findall(part))
        return found


_VOCABULARIES: dict[str, Vocabulary] = {}


def _vocabulary(path: str) -> Vocabulary:
    """One per worker process."""
    if path not in _VOCABULARIES:
        _VOCABULARIES[path] = Vocabulary(path)
    return _VOCABULARIES[path]


class Encoder:
    """Texts to ids, with a lexicon of frequent pieces or without."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon | None = None) -> None:
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def __call__(self, values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text begins and ends in it."""
        cut = cut_texts(values)
        distinct = cut.flatten().dictionary_encode()
        found = distinct.dictionary.to_pylist()
        missing = [p for p in found if p not in self.recent]
        if len(self.recent) + len(missing) > CACHED_PIECES:
            self.older, self.recent = self.recent, {}
            missing = found
        known = {p: self.older[p] for p in missing if p in self.older}
        new = [p for p in missing if p not in known] if known else missing
        self.recent.update(known)
        self.recent.update(zip(new, self._new(new)))
        parts = list(map(self.recent.__getitem__, found))
        for piece in new:
            if len(piece) > LONG_PIECE:  # not worth keeping
                del self.recent[piece]
        return spliced(parts, distinct.indices.to_numpy(), np.asarray(cut.offsets) - cut.offsets[0].as_py())

    def _new(self, found: list[str]) -> list[bytes]:
        """Ids of distinct pieces: from the lexicon, or cut into words that are merged."""
        out: list[bytes] = [b""] * len(found)
        rest = range(len(found))
        if self.lexicon is not None:
            ranks = self.lexicon.ranks([piece.encode() for piece in found])
            at = np.flatnonzero(ranks >= 0)
            for i, ids in zip(at.tolist(), self.lexicon.ids(ranks[at])):
                out[i] = ids
            rest = np.flatnonzero(ranks < 0).tolist()
        parts = [self._words(found[i]) for i in rest]
        words = list({w for own in parts for w in own if isinstance(w, str)})
        merged: dict[str | int, bytes] = dict(zip(words, self.vocabulary.merge([w.encode() for w in words])))
        merged.update((i, i.to_bytes(4, "little")) for i in self.vocabulary.added.values())
        for i, own in zip(rest, parts):
            out[i] = merged[own[0]] if len(own) == 1 else b"".join([merged[w] for w in own])
        return out

    def _words(self, piece: str) -> list[str | int] | tuple[str, ...]:
        """`Vocabulary.cut`, faster for letters with a blank or line end before, a stop or comma behind."""
        body, tail = (piece[:-1], piece[-1:]) if piece[-1:] in (",", ".") else (piece, "")
        first = body[:1]
        if first == "\n" and body[1:].isalpha():
            return ("\n", body[1:], tail) if tail else ("\n", body[1:])
        if body.isalpha() or first == " " and body[1:].isalpha():
            return (body, tail) if tail else (body,)
        return self.vocabulary.cut(piece) or ("",)


_ENCODERS: dict[tuple[str, str | None], Encoder] = {}


def _encoder(path: str, lexicon: str | None) -> Encoder:
    """One per worker process, so that later tasks find the cache filled."""
    key = (path, lexicon)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(_vocabulary(path), lexicon and Lexicon(SparkFiles.get(lexicon)))
    return _ENCODERS[key]


def count_pieces(docs: DataFrame, text: str = "text") -> DataFrame:
    """(piece string, n long): how often each piece occurs in all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, text, BATCH):
            found = pc.value_counts(cut_texts(batch.column(text)).flatten())
            yield pa.record_batch([found.field("values"), found.field("counts")], names=["piece", "n"])

    return docs.select(text).mapInArrow(count, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))


def build_lexicon(
    docs: DataFrame, path: str, text: str = "text", max_words: int = 100_000, max_length: int = 64
) -> str:
    """Compile the most frequent words of all texts; returns the name of the handed-out file.

    At most `max_words` words of at most `max_length` bytes reach the driver: the least count
    that keeps the list within that size is read off a histogram of counts.
    """
    counted = count_pieces(docs, text).filter((F.octet_length("piece") <= max_length) & (F.col("n") > 1))
    counted = written(counted, "pieces")
    step = F.floor(F.log2("n") * 16).cast("int")
    least, kept = 1 << 30, 0
    for row in counted.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():
        kept += row["count"]
        if kept > max_words:
            break
        least = row["step"]
    found = [r["piece"] for r in counted.filter(step >= least).select("piece").collect()]
    ids = Encoder(_vocabulary(path))._new(found)
    entries = ((p.encode(), np.frombuffer(i, "<i4").tolist()) for p, i in zip(found, ids))
    return shared_file(docs.sparkSession, compile_lexicon(entries), "lexicon")


def encode(docs: DataFrame, path: str, lexicon: str | None = None, text: str = "text") -> DataFrame:
    """`docs` with `ids` (array of int); `lexicon` is the file named by `build_lexicon`."""
    kept = [c for c in docs.columns if c != "ids"]
    out = T.StructType([docs.schema[c] for c in kept] + [T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, lexicon)
        for batch in by_bytes(batches, text, BATCH):
            flat, ends = encoder(batch.column(text))
            ids = pa.ListArray.from_arrays(pa.array(ends.astype("i4")), pa.array(flat))
            yield pa.record_batch([*(batch.column(c) for c in kept), ids], names=[*kept, "ids"])

    return docs.select(*dict.fromkeys([*kept, text])).mapInArrow(run, out)


def decode(docs: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """`docs` with the text that its ids spell; special tokens stay, null ids give empty text."""
    kept = [c for c in docs.columns if c not in (ids, text)]
    out = T.StructType([docs.schema[c] for c in kept] + [T.StructField(text, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _vocabulary(path).token_bytes
        spelled = [tokens.get(i, b"") for i in range(max(tokens) + 1)].__getitem__
        for batch in batches:
            for part in _by_ids(batch, ids):
                lists = part.column(ids)
                flat = lists.flatten().to_numpy().tolist()
                counts = np.asarray(pc.fill_null(pc.list_value_length(lists), 0), dtype=np.int64)
                ends = np.cumsum(counts).tolist()
                values = [
                    b"".join(map(spelled, flat[a:b])).decode("utf-8", "replace") for a, b in zip([0, *ends], ends)
                ]
                yield pa.record_batch(
                    [*(part.column(c) for c in kept), pa.array(values, pa.string())], names=[*kept, text]
                )

    return docs.select(*kept, ids).mapInArrow(run, out)


def _by_ids(batch: pa.RecordBatch, ids: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of about `most` ids."""
    ends = np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(batch.column(ids)), 0), dtype=np.int64))
    start = 0
    while start < len(ends):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop
