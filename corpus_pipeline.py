"""The corpus pipeline: language, near copies, repeated passages, packing.

Each stage reads what the one before has written and works on all of it. The first three return
documents with the columns they came with; the last returns packed token pieces.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mobility_lake import session
from mobility_lake.llm import language_mixture, ngram_join, packing, suffix_dedup
from mobility_lake.llm.common import noted, remove, ship, written

# The columns that stages work with; others get names that no operator has, and theirs back behind the stage.
OWN = ("doc_id", "text", "lang", "n_chars")
TOKENIZER = "word_bpe_49k.json"
PASSAGE = 256  # bytes of a repeated string that goes whatever its words
WORDS = 51  # words of a repeated passage that goes whatever its bytes


_LEFT: list[str] = []  # intermediates of the stage called last


def keeping(stage):
    """A stage whose other columns cannot clash with those it works with.

    A stage's result is written before the next one is called, which removes the intermediates it had.
    """

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        remove(spark, _LEFT)
        _LEFT.clear()
        names = docs.columns
        aside = [name if name in OWN else f"column{i}" for i, name in enumerate(names)]
        with noted() as made:
            out = stage(spark, docs.toDF(*aside), sf_dir)
        _LEFT.extend(made)
        return out.toDF(*names) if out.columns == aside else out

    return run


@keeping
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a learned language: those without a letter, or without text, go.

    The languages are learned from the labels of the documents that came in. `lang` keeps its
    label and is filled with the prediction where it was null.
    """
    ship(session.pin(spark))
    columns = docs.columns
    model = language_mixture.train(docs, F.lit(True))
    found = language_mixture.predict(docs, model)
    known = F.col("lang_pred") != language_mixture.UNKNOWN
    # Without any label there is nothing to tell languages by; letters still tell text.
    kept = found.filter(known if model.languages else F.col("text").rlike(r"\p{L}"))
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(columns)


@keeping
def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of near copies (five words, Jaccard of 0.75): that of the smallest id, null last.

    Every row is a document of its own, whatever its id. Rows without words are in no group and stay.
    """
    ship(session.pin(spark))
    columns = docs.columns
    keyed = written(docs.withColumn("_key", F.monotonically_increasing_id()), "keyed")
    groups = ngram_join.near_duplicates(keyed, doc_id="_key", words=5, percent=75)
    ranks = keyed.select(F.col("_key").alias("key"), F.col("doc_id").isNull().alias("none"), "doc_id")
    groups = groups.join(ranks, groups["_key"] == ranks["key"]).select("key", "component_id", "none", "doc_id")
    groups = written(groups, "groups")
    first = groups.groupBy("component_id").agg(F.min(F.struct("none", "doc_id", "key")).alias("_first"))
    dropped = groups.join(first.select(F.col("_first.key").alias("key")), "key", "left_anti")
    dropped = written(dropped.select(F.col("key").alias("_key")), "dropped")
    # Most rows stay as they are; only those in question are shuffled.
    maybe, stays = ngram_join.split_likely(keyed, dropped, "_key")
    return stays.unionByName(maybe.join(dropped, "_key", "left_anti")).select(columns)


@keeping
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut out strings of `WORDS` words or `PASSAGE` bytes or more that also start elsewhere; documents with nothing left go.

    What is left of a character that was cut into goes as well. `n_chars` is counted anew.
    """
    ship(session.pin(spark))
    removed = suffix_dedup.remove_passages(docs, words=WORDS, length=PASSAGE, as_text=True)
    texts = removed.withColumn("text", F.col("kept")).filter("text <> ''")
    if "n_chars" in docs.columns:
        texts = texts.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return texts.select(docs.columns)


@keeping
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences of at most 2,048: the places of their pieces, with their ids."""
    import public_tokenizers

    ship(session.pin(spark))
    pieces = packing.cut_documents(docs, public_tokenizers.path(TOKENIZER), capacity=2048, end_id=0, with_ids=True)
    return packing.pack(pieces, capacity=2048)


STAGES = [
    ("language", language),
    ("near_copies", near_copies),
    ("repeated_passages", repeated_passages),
    ("packed", packed),
]

# Not SQL: a fitted model, a tree join, sorted suffixes and a search. The tests hold a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    name, stage = STAGES[-1]
    return written(stage(spark, docs, sf_dir), f"pipeline-{name}")
