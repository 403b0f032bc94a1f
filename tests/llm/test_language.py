import random

import numpy as np
from pyspark.sql import functions as F

from mobility_lake.llm import language_mixture as lm

random.seed(5)
SOUNDS = {"xx": ["ka", "ro", "mi", "tu"], "yy": ["sch", "eng", "ber", "ün"], "zz": ["eau", "oi", "él", "que"]}


def text(lang, words=60):
    return " ".join("".join(random.choices(SOUNDS[lang], k=random.randint(1, 4))) for _ in range(words))


def docs(spark):
    rows = [(i, text(lang), lang) for i, lang in enumerate(random.choices(list(SOUNDS), k=300))]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_held_out_accuracy_and_mixtures(spark):
    table = docs(spark)
    model = lm.train(table, F.col("doc_id") < 200)
    held = lm.predict(table.filter("doc_id >= 200"), model).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.97
    mixed = spark.createDataFrame([(1, text("xx", 200) + " " + text("zz", 100))], "doc_id long, text string")
    row = lm.predict(mixed, model).first()
    assert row["lang_pred"] == "xx" and row["languages"] == ["xx", "zz"]
    assert abs(row["proportions"][0] - 0.6) < 0.2 and abs(sum(row["proportions"]) - 1) < 1e-6


def test_odd_texts(spark, documents, clashing, nothing):
    model = lm.train(documents, F.lit(True))
    rows = {r["text"]: r for r in lm.predict(clashing, model).collect()}
    assert len(lm.predict(clashing, model).collect()) == 16
    for value in (None, "", " \n\t ", "1234 !!! ###"):
        assert rows[value]["lang_pred"] == "und" and rows[value]["score"] == 0 and rows[value]["languages"] == []
    assert all(0 <= r["score"] <= 1 for r in rows.values())
    assert lm.predict(nothing, model).collect() == []
    unlearned = lm.train(nothing, F.lit(True))
    assert {r["lang_pred"] for r in lm.predict(documents, unlearned).collect()} == {"und"}


def test_likelihood_rises_with_every_step():
    rng = np.random.default_rng(2)
    probabilities = rng.dirichlet(np.ones(50), 3)
    counts = rng.multinomial(200, 0.5 * probabilities[0] + 0.5 * probabilities[2], 4).astype(float)
    steps = [lm.mixture(counts, probabilities, np.ones((4, 3)), n)[1] for n in (0, 1, 2, 5, 20)]
    assert all((b >= a - 1e-6).all() for a, b in zip(steps, steps[1:]))


def test_a_language_on_one_id_is_sampled_by_text(spark):
    random.seed(3)
    rows = [(5, f"aka kaa aak {i} " * 5, "aa") for i in range(4000)] + [(None, f"bobo obbo {i} " * 5, "bb") for i in range(4000)]
    given = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = lm.train(given, F.lit(True), sample_rows=200)
    found = lm.predict(given, model).groupBy("lang", "lang_pred").count().collect()
    assert {(r["lang"], r["lang_pred"]) for r in found} == {("aa", "aa"), ("bb", "bb")}
