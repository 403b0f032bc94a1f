import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from mobility_lake.llm import bpe
from mobility_lake.llm.lexicon import Lexicon, compile_lexicon

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    None, "", " ", "\n \n", " a", "a ", "a\n\nb", "it's  we'll\t\tgo \x1c \x85 z", "a　 b", "a\xa0 b\nc", "a \x01 b",
    "x <|endoftext|> y\n\n<|endoftext|>", "12 345  \xe9́ \U0001f600 \n", "aaaaaaaaaaa aaaaa bbbbbbb", "x" * 3000,
    "Unseen wordsmithery, and 'tis fine.", "Unseen wordsmithery, and 'tis fine.",
]


def test_lexicon_shares_suffixes_and_finds_its_words_only(tmp_path):
    words = [b"walking", b"talking", b"walked", b"talked", b"a", b"ab", "\xe9t\xe9".encode()]
    file = tmp_path / "lexicon"
    file.write_bytes(compile_lexicon((w, [i, i + 100]) for i, w in enumerate(words)))
    found = Lexicon(str(file))
    ranks = found.ranks([*words, b"walk", b"", b"abc", b"zzz"])
    assert (ranks[-4:] == -1).all() and sorted(ranks[:-4]) == list(range(len(words)))
    assert found.ids(ranks[:1])[0] == b"\0\0\0\0\x64\0\0\0"
    assert found.states < sum(map(len, words)) - 8


def test_empty_lexicon(tmp_path):
    file = tmp_path / "lexicon"
    file.write_bytes(compile_lexicon([]))
    assert Lexicon(str(file)).ranks([b"a", b""]).tolist() == [-1, -1]


@pytest.mark.parametrize("with_lexicon", [False, True])
def test_equals_the_library_and_decodes_back(spark, with_lexicon):
    docs = spark.createDataFrame([(i, t, "old") for i, t in enumerate(TEXTS)], "doc_id int, text string, ids string")
    lexicon = bpe.build_lexicon(docs, PATH, max_words=20) if with_lexicon else None
    rows = bpe.decode(bpe.encode(docs, PATH, lexicon).withColumn("copy", F.col("ids")), PATH).collect()
    library = Tokenizer.from_file(PATH)
    assert len(rows) == len(TEXTS)
    for row in rows:
        ids = library.encode(TEXTS[row["doc_id"]] or "", add_special_tokens=False).ids
        assert row["copy"] == ids
        assert row["decoded"] == library.decode(ids, skip_special_tokens=False)


def test_empty_table(spark, nothing):
    lexicon = bpe.build_lexicon(nothing, PATH)
    assert bpe.decode(bpe.encode(nothing, PATH, lexicon), PATH).collect() == []
