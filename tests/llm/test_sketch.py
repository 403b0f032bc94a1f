import random
import re

from pyspark.sql import functions as F

from mobility_lake.llm import paragraph_sketch as ps
from mobility_lake.llm import queries


def paragraphs(text):
    return set(re.findall(ps.PARAGRAPHS.replace("$", r"\Z"), text))


def likeness(a, b):
    a, b = paragraphs(a), paragraphs(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_differences_of_any_size_are_recovered(spark):
    rows = [([i for i in range(n)], [i for i in range(d, n + e)]) for n, d, e in ((0, 0, 0), (5, 0, 0), (5, 1, 1), (40, 3, 8), (300, 100, 50), (0, 0, 700))]
    df = spark.createDataFrame(rows, "l array<long>, r array<long>")
    df = df.select(F.transform("l", lambda x: F.xxhash64(x)).alias("l"), F.transform("r", lambda x: F.xxhash64(x)).alias("r"))
    for row in df.withColumn("d", ps.differing("l", "r")).collect():
        found = {(x["id"], x["n"]) for x in row["d"]}
        assert found == {(x, 1) for x in set(row["l"]) - set(row["r"])} | {(x, -1) for x in set(row["r"]) - set(row["l"])}
        assert len(row["d"]) == len(found)


def test_next_row_wraps_and_orders_ties(spark):
    rows = [(i * 7 % 1000, f"t{i}") for i in range(1000)] + [(None, "null"), (5, "tie")]
    df = spark.createDataFrame(rows, "k long, v string")
    found = ps.with_next(df, "k", {"v": F.col("v")}, F.col("v")).collect()
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    following = {order[i]: order[(i + 1) % len(order)][1] for i in range(len(order))}
    assert {(r["k"], r["v"]): r["next_v"] for r in found} == following
    one = spark.createDataFrame([(1, "only")], "k long, v string")
    assert ps.with_next(one, "k", {"v": F.col("v")}, F.col("v")).first()["next_v"] == "only"


def test_query_on_odd_documents(spark, documents, folder):
    documents.write.parquet(f"{folder}/documents.parquet")
    rows = queries.QUERIES["op1_paragraph_sketch"](spark, folder).collect()
    given = sorted(
        ((r["doc_id"], r["text"] or "") for r in documents.collect()), key=lambda r: (r[0] is None, -(r[0] or 0))
    )
    assert len(rows) == len(given)
    by_id = {r["doc_id"]: r for r in rows}
    for i, (doc_id, text) in enumerate(given):
        if doc_id == 3:
            continue  # two equal rows follow each other
        following = given[(i + 1) % len(given)][1]
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        row = by_id[doc_id]
        assert row["n_chars"] == len(text)
        assert abs(row["near_edited"] - likeness(text, edited)) < 1e-9
        assert abs(row["near_next"] - likeness(text, following)) < 1e-9
    prints = {}
    for (doc_id, text) in given:
        assert prints.setdefault(text, by_id[doc_id]["fingerprint"]) == by_id[doc_id]["fingerprint"]
    assert len(set(prints.values())) == len(prints)


def test_versions_of_undelimited_texts_share_paragraphs(spark):
    random.seed(6)
    texts = [
        "".join(random.choices("的一是了我不在人有他这中大来上个国", k=3000)), "".join(random.choices("abcdefgh0123", k=2500)),
        " ".join("".join(random.choices("abcdefghij", k=random.randint(2, 9))) for _ in range(600)),
        "\t".join(f"k{i} = f({i * i})" for i in range(200)), " ".join(f"word{i * i}" for i in range(30)), "a short text of some few words only",
    ]
    rows = [(t, t[: len(t) - len(t) // 3] + "".join(random.choices("xyz ", k=len(t) // 3)), t[:7] + "+" + t[7:]) for t in texts]
    df = spark.createDataFrame(rows, "t string, cut string, put string").select(*(ps.digests(F.col(c)).alias(c) for c in ("t", "cut", "put")))
    for text, row in zip(texts, df.collect()):
        own, cut, put = (set(row[c]) for c in ("t", "cut", "put"))
        assert len(own) == len(paragraphs(text))
        assert len(own & cut) / len(own | cut) > 0.1, text
        if len(text) > 500:
            assert len(own & put) / len(own | put) > 0.5, text


def test_ids_up_to_the_largest_and_ties(spark):
    top = 2**63 - 1
    rows = [(top - i, f"t{i}") for i in range(300)] + [(-(2**63) + i, f"u{i}") for i in range(300)] + [(top, "again")]
    found = ps.with_next(spark.createDataFrame(rows, "k long, v string"), "k", {"v": F.col("v")}, F.col("v")).collect()
    order = sorted(rows, key=lambda r: (-r[0], r[1]))
    following = {order[i]: order[(i + 1) % len(order)][1] for i in range(len(order))}
    assert {(r["k"], r["v"]): r["next_v"] for r in found} == following


def test_estimated_difference_is_exact_for_small_sets(spark):
    rows = [(list(range(40)), list(range(10, 60))), ([], []), ([], [1, 2]), (list(range(9)), list(range(9)))]
    df = spark.createDataFrame(rows, "l array<long>, r array<long>")
    found = [round(r["far"], 9) for r in df.select(F.expr(ps.apart("l", "r")).alias("far")).collect()]
    assert found == [30.0, 0.0, 2.0, 0.0]


def test_query_on_nothing(spark, nothing, folder):
    nothing.write.parquet(f"{folder}/documents.parquet")
    assert queries.QUERIES["op1_paragraph_sketch"](spark, folder).collect() == []
