"""Language identification as a mixture of languages.

Each language is a distribution over hashed byte trigrams of lower-cased text, counted on a
bounded sample of labelled documents. A document's n-grams are taken as drawn from a mixture;
expectation-maximisation finds the proportions of all languages, then of the most likely 2, 3, ...
of them, and the set whose likelihood is best after a penalty per further language is kept
(`penalty` times the logarithm of the number of n-grams). The prediction is its largest part.

Whole texts are read; only the text decides. A document that is null, or has no letter, is `und` with
score 0 and no languages; so is every document if nothing is labelled. The score is
the share of the predicted language among all. Ties go to the language that sorts first.
Rows map one to one, so repeated rows get equal results; columns of the input pass through and those
named like a result are replaced. A sampled document counts `sample_rows` per language in
expectation: it is taken by a hash of the document's id and text, so a rerun takes the same.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mobility_lake.llm.common import by_bytes, texts

BUCKETS = 1 << 13
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")
# Everything in ASCII but letters separates words.
SPACED = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))
DOCUMENTS = 256  # at a time
STEPS = 12


@dataclass(frozen=True)
class Model:
    """Smoothed trigram probabilities, a row per language."""

    languages: tuple[str, ...]
    probabilities: np.ndarray


def ngram_counts(values: list[str]) -> np.ndarray:
    """Trigram counts, a row per text."""
    raw = [b" " + value.lower().encode().translate(SPACED) + b"  " for value in values]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    letters = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint32)
    code = (letters[:-2] << 16) | (letters[1:-1] << 8) | letters[2:]
    blank = (letters[:-2] == 32) & (letters[1:-1] == 32)  # runs of separators say nothing
    code = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - 13)
    owner = np.repeat(np.arange(len(raw)), sizes)[:-2]
    ends = np.cumsum(sizes)
    inside = np.arange(len(code)) + 2 < ends[owner]
    keep = inside & ~blank
    at = owner[keep] * BUCKETS + code[keep]
    return np.bincount(at, minlength=len(raw) * BUCKETS).reshape(len(raw), BUCKETS)


def train(
    docs: DataFrame, labelled: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
    sample_rows: int = 2_000, max_languages: int = 200,
) -> Model:
    """Learn from about `sample_rows` documents of each language among the `labelled` rows.

    More than `max_languages` labels raise: the model goes to every task.
    """
    rows = docs.filter(labelled & F.col(lang).isNotNull())
    sizes = {r[lang]: r["count"] for r in rows.groupBy(lang).count().limit(max_languages + 1).collect()}
    if len(sizes) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    languages = tuple(sorted(sizes))
    if not languages:
        return Model((), np.zeros((0, BUCKETS)))
    share = F.create_map(*(F.lit(x) for name in languages for x in (name, min(1.0, sample_rows / sizes[name]))))
    drawn = F.pmod(F.xxhash64(F.col(doc_id).cast("string"), F.col(text)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = rows.filter(drawn < share[F.col(lang)]).select(F.col(lang).alias("_lang"), F.col(text).alias("_text"))
    number = {name: i for i, name in enumerate(languages)}
    schema = pa.schema([("language", pa.int32()), ("bucket", pa.int32()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(languages), BUCKETS), np.int64)
        for part in _few(by_bytes(batches, "_text")):
            counts = ngram_counts(texts(part, "_text"))
            owner = np.array([number[name] for name in part.column("_lang").to_pylist()])
            for i in np.unique(owner):
                total[i] += counts[owner == i].sum(axis=0)
        language, bucket = np.nonzero(total)
        yield pa.record_batch(
            [language.astype("i4"), bucket.astype("i4"), total[language, bucket]], schema=schema
        )

    # At most BUCKETS rows per language.
    counted = sample.mapInArrow(count, "language int, bucket int, n long").groupBy("language", "bucket").agg(F.sum("n"))
    total = np.full((len(languages), BUCKETS), 0.5)
    for language, bucket, n in counted.collect():
        total[language, bucket] += n
    return Model(languages, total / total.sum(axis=1, keepdims=True))


def _few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, DOCUMENTS):
            yield batch.slice(start, DOCUMENTS)


def mixture(counts: np.ndarray, probabilities: np.ndarray, allowed: np.ndarray, steps: int = STEPS):
    """(proportions, log-likelihood) of each document over its `allowed` languages by EM."""
    shares = allowed / allowed.sum(axis=1, keepdims=True)
    total = np.maximum(counts.sum(axis=1, keepdims=True), 1)
    for _ in range(steps):
        shares = shares * ((counts / (shares @ probabilities)) @ probabilities.T) / total
        shares = np.maximum(shares, 1e-12) * allowed
        shares /= shares.sum(axis=1, keepdims=True)
    return shares, (counts * np.log(shares @ probabilities)).sum(axis=1)


def infer(counts: np.ndarray, model: Model, penalty: float) -> tuple[np.ndarray, np.ndarray]:
    """Proportions over all languages, and over the kept set of each document."""
    probabilities = model.probabilities.astype(np.float32)
    counts = counts.astype(np.float32)
    some = np.ones((len(counts), len(model.languages)), np.float32)
    overall, _ = mixture(counts, probabilities, some)
    overall = overall.astype(np.float64)
    place = np.argsort(np.argsort(-overall, axis=1, kind="stable"), axis=1)  # 0 for the largest part
    kept = (place == 0).astype(np.float64)
    best = (counts * np.log(probabilities)[overall.argmax(axis=1)]).sum(axis=1)
    price = penalty * np.log(np.maximum(counts.sum(axis=1), 2))
    active = np.arange(len(counts))
    for size in range(2, len(model.languages) + 1):
        shares, likelihood = mixture(counts[active], probabilities, (place[active] < size).astype(np.float32))
        better = likelihood - best[active] > price[active]
        active = active[better]
        if not len(active):
            break
        kept[active], best[active] = shares[better], likelihood[better]
    return overall, kept


def predict(docs: DataFrame, model: Model, text: str = "text", penalty: float = 8.0) -> DataFrame:
    """`docs` with `lang_pred`, `score`, and `languages` with `proportions`, largest part first."""
    results = [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("languages", T.ArrayType(T.StringType())),
        T.StructField("proportions", T.ArrayType(T.DoubleType())),
    ]
    names = [f.name for f in results]
    passed = [c for c in docs.columns if c not in names]
    schema = T.StructType([docs.schema[c] for c in passed] + results)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _few(by_bytes(batches, text)):
            values = texts(part, text)
            found = [(UNKNOWN, 0.0, [], [])] * len(values)
            readable = [i for i, value in enumerate(values) if LETTER.search(value)] if model.languages else []
            if readable:
                overall, kept = infer(ngram_counts([values[i] for i in readable]), model, penalty)
                for i, shares, own in zip(readable, overall, kept):
                    order = [j for j in np.argsort(-own, kind="stable") if own[j] > 0]
                    top = order[0]
                    found[i] = (
                        model.languages[top],
                        min(1.0, float(shares[top])),
                        [model.languages[j] for j in order],
                        [float(own[j]) for j in order],
                    )
            columns = [pa.array([f[k] for f in found], kind) for k, kind in enumerate(ARROW)]
            yield pa.record_batch([*(part.column(c) for c in passed), *columns], names=[*passed, *names])

    return docs.select(*dict.fromkeys([*passed, text])).mapInArrow(run, schema)


ARROW = (pa.string(), pa.float64(), pa.list_(pa.string()), pa.list_(pa.float64()))
