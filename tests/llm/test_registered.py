"""The registered queries against their SQL, and the pipeline against plain versions."""

import brute
import duckdb
import oracle
import pytest

import corpus_pipeline
from mobility_lake.llm import queries
from mobility_lake.llm.common import written


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, sf, name):
    only_spark, only_sql, wrong = oracle.compare(queries.QUERIES[name](spark, sf), oracle.connect(sf), queries.ORACLE[name])
    assert not wrong and not only_spark and not only_sql, (only_spark[:2], only_sql[:2])


def rows_of(sf):
    return duckdb.sql(f"select doc_id, text from '{sf}/documents.parquet' order by doc_id").fetchall()


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_near_copies(spark, sf):
    found = sorted(tuple(r) for r in queries.QUERIES["op6_ngram_join"](spark, sf).collect())
    assert found == brute.near_components(*zip(*rows_of(sf)))


def test_repeats(spark, sf):
    given = rows_of(sf)
    found = {r["doc_id"]: r for r in queries.QUERIES["op10_suffix_dedup"](spark, sf).collect()}
    for (doc_id, text), (spans, kept) in zip(given, brute.without_repeats([t for _, t in given], 400)):
        row = found[doc_id]
        size = len((text or "").encode())
        assert (row["n_bytes"], row["n_removed"], row["n_spans"]) == (size, size - len(kept), len(spans))
        assert row["kept_sha256"] == brute.sha(kept)


def test_languages_of_held_out_documents(spark, sf):
    labels = dict(duckdb.sql(f"select doc_id, lang from '{sf}/documents.parquet'").fetchall())
    rows = [r for r in queries.QUERIES["op3_language_mixture"](spark, sf).collect() if r["held_out"]]
    assert sum(r["lang_pred"] == labels[r["doc_id"]] for r in rows) >= 0.95 * len(rows)


def test_pipeline_stages(spark, documents, sf):
    docs = documents
    columns = docs.columns
    (_, language), (_, near), (_, repeats), (_, packed) = corpus_pipeline.STAGES
    kept = written(language(spark, docs, sf), "test")
    assert kept.columns == columns and sorted(r["doc_id"] or 0 for r in kept.collect()) == sorted(
        r["doc_id"] or 0 for r in docs.collect() if r["text"] and any(c.isalpha() for c in r["text"])
    )
    once = written(near(spark, kept, sf), "test")
    assert once.columns == columns
    assert sorted(r["doc_id"] or 0 for r in once.collect()) == [0, 1, 2, 7, 9, 10, 11, 12]
    cut = written(repeats(spark, once, sf), "test")
    assert cut.columns == columns
    given = once.collect()
    expected = {}
    for r, (_, rest) in zip(given, brute.without_repeats([r["text"] for r in given], corpus_pipeline.PASSAGE)):
        text = rest.decode("utf-8", "ignore")
        if text:
            expected[r["doc_id"]] = (text, len(text))
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in cut.collect()} == expected
    assert "passage100" not in expected[10][0] and expected[1][0] == docs.filter("doc_id = 1").first()["text"]
    assert packed(spark, cut, sf).count() >= len(expected)
    nothing = docs.filter("1 = 0")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, sf).collect() == []


def test_formatted_length_counts_all_marks(spark, folder):
    rows = [(1, 0, "user", "x |> y <| \\ |><|"), (1, 1, "assistant", "|>|>"), (2, 0, None, None)]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(f"{folder}/conversations.parquet")
    connection = duckdb.connect()
    connection.sql(f"create view conversations as select * from '{folder}/conversations.parquet/*.parquet'")
    name = "op7_reply_trees"
    assert not any(oracle.compare(queries.QUERIES[name](spark, folder), connection, queries.ORACLE[name]))


def test_pipeline_keeps_foreign_columns(spark, clashing, sf):
    """Columns named like working columns of the stages keep their values."""
    from pyspark.sql import functions as F

    names = "_part _key _bit _word split_likely languages proportions column5 _found _id".split()
    docs = clashing.withColumns({n: F.lit(0.125) for n in names if n not in clashing.columns})
    (_, language), (_, near), (_, repeats), _ = corpus_pipeline.STAGES
    for stage in (language, near, repeats):
        docs = written(stage(spark, docs, sf), "test")
        for row in docs.collect():
            assert all(row[n] == 0.125 for n in names) and row["score"] == row["spans"] == row["kept"] == row["_row"] == 7
    assert docs.count() > 5


def test_pipeline_runs_over_its_table(spark, sf):
    assert corpus_pipeline.run(spark, sf).count() > 0


def test_near_copies_takes_rows_not_ids(spark):
    texts = [" ".join(f"w{k}x{i}" for i in range(40)) for k in range(6)]
    near = texts[1] + " end"
    rows = [(1, texts[0]), (1, texts[2]), (1, texts[3]), (None, near), (4, texts[1]), (None, texts[4]), (None, texts[4]), (7, texts[2]), (1, texts[5]), (1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = sorted((tuple(r) for r in dict(corpus_pipeline.STAGES)["near_copies"](spark, docs, "").collect()), key=repr)
    assert kept == sorted(
        [(1, texts[0]), (1, texts[2]), (1, texts[3]), (4, texts[1]), (None, texts[4]), (1, texts[5]), (1, None)], key=repr
    )
