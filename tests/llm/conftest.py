import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from mobility_lake.llm.common import ship  # noqa: E402


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture
def documents(spark):
    """Documents with nulls, empty and long texts, repeated rows and columns that clash."""
    near = " ".join(f"word{i}" for i in range(80))
    passage = " ".join(f"passage{i * i}" for i in range(70))
    rows = [
        (1, "The quick brown fox.\nJumps over the lazy dog today.", "en", "a", 1),
        (2, near, "en", "a", None),
        (3, near + " end", None, "a", 0),
        (3, near + " end", None, "a", 0),
        (4, None, "en", None, 0),
        (5, "", "fr", "b", 0),
        (6, " \n\t ", None, "b", 3),
        (7, "one two", "en", "b", 7),
        (8, "One  TWO", "en", "b", 8),
        (9, "a" * 5000, None, "c", 5000),
        (10, "intro " + passage + " middle", "en", "c", 0),
        (11, "other text " + passage + " ".join(f" éàü{i}" for i in range(60)) + passage, "fr", "c", 0),
        (None, "a row without an id", "en", "c", 0),
        (12, ("véry löng text. " * 3000) + "x", "fr", "c", 0),
        (13, "1234 !!! ###", None, "c", 0),
        (14, near.upper(), "en", "d", 0),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture
def clashing(documents):
    from pyspark.sql import functions as F

    names = "id ids shard slot spans kept piece size unit a b node component _text _row lang_pred score".split()
    return documents.withColumns({n: F.lit(7) for n in names})


@pytest.fixture
def nothing(documents):
    return documents.filter("1 = 0")
