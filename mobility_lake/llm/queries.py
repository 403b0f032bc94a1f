"""The registered queries of this package: thin calls of its operators over the given tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mobility_lake import session
from mobility_lake.llm import bpe
from mobility_lake.llm import histogram_sort as hs
from mobility_lake.llm import kd_search as kd
from mobility_lake.llm import language_mixture as lm
from mobility_lake.llm import lexical_rank as lr
from mobility_lake.llm import ngram_join as nj
from mobility_lake.llm import packing
from mobility_lake.llm import paragraph_sketch as ps
from mobility_lake.llm import reply_trees as rt
from mobility_lake.llm import run_detection as rd
from mobility_lake.llm import suffix_dedup as sd
from mobility_lake.llm import token_file as tf
from mobility_lake.llm import warc
from mobility_lake.llm.common import ship, table, whole, written

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf: str) -> DataFrame:
            ship(session.pin(spark))
            return build(spark, sf)

        run.__name__, run.__doc__ = name, build.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return build

    return register


@query("op8_histogram_sort")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's shard of 16 with near equal bytes, equal texts together, and its slot."""
    rows = table(spark, sf, "documents").select(
        "doc_id",
        (F.octet_length(whole()) + 1).cast("long").alias("size"),
        F.crc32(whole().cast("binary")).alias("text_crc32"),
        F.xxhash64(whole()).alias("text_hash"),
    )
    return hs.histogram_sort(rows, F.col("text_hash"), F.col("doc_id"), F.col("size")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op4_bpe_transducer")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    """Ids of every document through the transducer lexicon, and the text they decode to."""
    path = _tokenizer("byte_bpe_50k.json")
    docs = table(spark, sf, "documents").select("doc_id", "text")
    lexicon = bpe.build_lexicon(docs, path)
    ids = bpe.encode(docs, path, lexicon).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        "ids",
    )
    return bpe.decode(ids, path).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256")
    )


def _resolved_sql(text: str) -> str:
    cases = " ".join(
        f"when n = '{name}' then '{character.replace(chr(39), chr(39) * 2)}' || substr(p, length(n) + 2)"
        for name, character in warc.REFERENCES.items()
    )
    return f"""array_to_string(list_transform(
        list_transform(string_split({text}, '&'),
            lambda p, i: {{'p': p, 'i': i, 'n': regexp_extract(p, '{warc.REFERENCE}', 1)}}),
        lambda x: case when x.i = 1 then x.p
            when x.n like '#%' and try_cast(substr(x.n, 2) as int) between 1 and 1114111
                and try_cast(substr(x.n, 2) as int) not between 55296 and 57343
                then chr(try_cast(substr(x.n, 2) as int)) || substr(x.p, length(x.n) + 2)
            {cases.replace("n =", "x.n =").replace("substr(p, length(n)", "substr(x.p, length(x.n)")}
            else '&' || x.p end), '')"""


def _uuid_sql(*parts: str) -> str:
    digest = "sha256(" + " || chr(10) || ".join(parts) + ")"
    return (
        f"'<urn:uuid:' || substr({digest}, 1, 8) || '-' || substr({digest}, 9, 4) || '-8' || substr({digest}, 14, 3)"
        f" || '-a' || substr({digest}, 18, 3) || '-' || substr({digest}, 21, 12) || '>'"
    )


def _field_sql(name: str, value: str) -> str:
    return (
        f"case when trim(regexp_replace({value}, '\\s+', ' ', 'g')) != '' then '{name}: ' || "
        f"trim(regexp_replace({value}, '\\s+', ' ', 'g')) || chr(13) || chr(10) else '' end"
    )


WARC_SQL = f"""
with response as (
    select page_id, coalesce(url, '') as target_uri, coalesce(html, '') as payload,
        'sha256:' || sha256(coalesce(html, '')) as payload_digest
    from pages
), named as (
    select *, {_uuid_sql("'response'", "target_uri", "'2024-01-01T00:00:00Z'", "payload_digest")} as refers_to,
        {_resolved_sql(f"regexp_extract(payload, '{warc.TITLE}', 1)")} as title,
        regexp_extract(payload, '{warc.LANGUAGE}', 1) as language,
        regexp_extract_all(payload, '{warc.LINK}', 1) as links,
        {_resolved_sql(f"regexp_replace(regexp_replace(regexp_replace(payload, '{warc.HIDDEN}', '', 'g'), '{warc.LINE_TAGS}', chr(10), 'g'), '{warc.OTHER_TAGS}', '', 'g')")} as words
    from response
), derived as (
    select page_id, target_uri, refers_to, 'metadata' as record_type,
        'http-status: 200' || chr(13) || chr(10) || 'source-content-type: text/html; charset=utf-8' || chr(13)
        || chr(10) || 'source-payload-digest: ' || payload_digest || chr(13) || chr(10)
        || {_field_sql("title", "title")} || {_field_sql("language", "language")}
        || array_to_string(list_transform(links,
            lambda l: 'outlink: ' || {_resolved_sql("l")} || chr(13) || chr(10)), '') as block
    from named
    union all
    select page_id, target_uri, refers_to, 'conversion',
        trim(regexp_replace(regexp_replace(regexp_replace(words, '{warc.BLANKS}', ' ', 'g'),
            '\\n[\\n ]+', chr(10), 'g'), ' \\n', chr(10), 'g'), ' ' || chr(10))
    from named
)
select page_id, record_type, {_uuid_sql("record_type", "refers_to")} as derived_id, refers_to, target_uri,
    block, 'sha256:' || sha256(block) as block_digest, strlen(block)::bigint as content_length
from derived
"""


@query("op5_warc_derivatives", WARC_SQL)
def op5(spark: SparkSession, sf: str) -> DataFrame:
    """The metadata and conversion records derived from a response record of every page."""
    pages = table(spark, sf, "pages").select("page_id", "url", "html")
    return warc.derive(warc.responses(pages)).select(
        "page_id", "record_type", "derived_id", "refers_to", "target_uri", "block", "block_digest", "content_length"
    )


def _read_back(batches):
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            formatted, turns = row["formatted"], rt.read_turns(row["formatted"])
            learned = "".join(rt.unescape(formatted[s["start"] : s["stop"]]) for s in row["loss_spans"])
            said = "".join(f"{role}\n{text}\n" for role, text in turns)
            out.append(
                {
                    "conv_id": row["tree"],
                    "n_turns": len(turns),
                    "turns_sha256": hashlib.sha256(said.encode()).hexdigest(),
                    "loss_chars": len(learned),
                    "loss_sha256": hashlib.sha256(learned.encode()).hexdigest(),
                    "formatted_chars": len(formatted),
                }
            )
        yield pa.RecordBatch.from_pylist(out, READ_BACK)


READ_BACK = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
    ]
)

REPLY_SQL = """
with said as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all
    select * from (values (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
), sized as (
    select *, length(role) + length(text) + 13
        + length(replace(replace(replace(role, '\\', '\\\\'), '<|', '<\\|'), '|>', '|\\>')) - length(role)
        + length(replace(replace(replace(text, '\\', '\\\\'), '<|', '<\\|'), '|>', '|\\>')) - length(text)
        as formatted
    from said
)
select conv_id, count(*)::bigint as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
    sum(case when role = 'assistant' then length(text) else 0 end)::bigint as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), ''))
        as loss_sha256,
    sum(formatted)::bigint as formatted_chars
from sized
group by conv_id
"""


@query("op7_reply_trees", REPLY_SQL)
def op7(spark: SparkSession, sf: str) -> DataFrame:
    """Every conversation formatted with a loss mask and read back; each turn answers the one before."""
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    words = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", words), (-7, 1, "assistant", words)], rows.schema)
    order = Window.partitionBy("conv_id").orderBy("turn", F.coalesce("role", F.lit("")), whole())
    thread = rows.unionByName(extra).withColumn("message", F.row_number().over(order))
    thread = thread.withColumn("parent", F.when(F.col("message") > 1, F.col("message") - 1))
    formatted = rt.conversations(thread, "conv_id", "message", "parent", "role", "text")
    return formatted.select("tree", "formatted", "loss_spans").mapInArrow(
        _read_back,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )


KD_SQL = """
with usable as (
    select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
    from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select q.vec_id as query_id, r.vec_id,
        list_sum(list_transform(list_zip(q.v, r.v), lambda p: p[1] * p[2]))::bigint as score
    from usable q join usable r on q.vec_id % 50 = 0 and q.vec_id <> r.vec_id
), ranked as (
    select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""


@query("op2_kd_tree_search", KD_SQL)
def op2(spark: SparkSession, sf: str) -> DataFrame:
    """The 5 best inner products of every vector whose id is divisible by 50, against all vectors."""
    vectors = table(spark, sf, "embeddings").select("vec_id", "embedding")
    return kd.top_k(vectors, F.col("vec_id") % 50 == 0, "vec_id", "embedding", k=5, scale=256.0)


@query("op9_swap_packing")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's token pieces and their places in sequences of 2,048 tokens."""
    docs = table(spark, sf, "documents")
    pieces = packing.cut_documents(docs, _tokenizer("word_bpe_49k.json"), capacity=2048, end_id=0)
    return packing.pack(pieces, capacity=2048).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1


@query("op3_language_mixture")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's language; learned from labelled documents that are not held out."""
    docs = table(spark, sf, "documents")
    model = lm.train(docs, ~F.coalesce(held_out(), F.lit(True)))
    found = lm.predict(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score", "languages", "proportions"
    )


@query("op1_paragraph_sketch")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's fingerprint, its edited text's, and how alike it is to that and to the next one's."""
    docs = table(spark, sf, "documents").select("doc_id", whole().alias("text"))
    docs = docs.withColumn("n_chars", F.char_length("text")).withColumn("digests", ps.digests(F.col("text")))
    docs = ps.with_next(docs, "doc_id", {"text": F.col("text"), "digests": F.col("digests")}, F.xxhash64("text"))
    third = F.floor(F.col("n_chars") / 3).cast("int")
    docs = docs.withColumn(
        "edited", F.concat(F.left("text", F.col("n_chars") - third), F.left("next_text", third))
    ).drop("next_text", "text")
    docs = docs.withColumns({"edited_sha256": F.sha2("edited", 256), "edited_digests": ps.digests(F.col("edited"))})
    docs = docs.drop("edited").withColumns(
        {"cells": ps.smallest("digests"), "edited_cells": ps.smallest("edited_digests")}
    )
    docs = docs.withColumns(
        {
            "to_edited": ps.differing("digests", "edited_digests", "cells", "edited_cells"),
            "to_next": ps.differing("digests", "next_digests", "cells"),
        }
    )
    return docs.select(
        "doc_id",
        F.col("n_chars").cast("long").alias("n_chars"),
        "edited_sha256",
        ps.spelled("digests", "cells").alias("fingerprint"),
        ps.spelled("edited_digests", "edited_cells").alias("edited_fingerprint"),
        ps.likeness("digests", "edited_digests", "to_edited").alias("near_edited"),
        ps.likeness("digests", "next_digests", "to_next").alias("near_next"),
    )


@query("op6_ngram_join")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's number of 5-word shingles and its component of near copies (Jaccard of 0.75 or more)."""
    return nj.near_duplicates(table(spark, sf, "documents"), words=5, percent=75)


@query("op10_suffix_dedup")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    """Every document without the bytes of 400-byte strings that start anywhere else as well."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["stop"] - s["start"])
    return sd.remove_repeats(docs, length=400).select(
        "doc_id",
        F.octet_length(whole()).cast("long").alias("n_bytes"),
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def _with_cycles(docs: DataFrame) -> DataFrame:
    """In a tenth of the documents, by a hash of their id, the words from one on follow a cycle of the first of them."""
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    given, count = F.floor(hashed / 10), F.size("words")
    words = F.when(hashed % 10 == 0, F.expr(r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)"))
    docs = docs.withColumn("words", words).withColumn("words", F.when(count > 0, F.col("words")))
    docs = docs.withColumn("first", (given % count).cast("int"))
    rest = count - F.col("first")
    docs = docs.withColumn("period", (1 + F.floor(rest / (3 + given % 8))).cast("int"))
    cycle = F.array_repeat(F.slice("words", F.col("first") + 1, F.col("period")), F.ceil(rest / F.col("period")).cast("int"))
    cycled = F.concat(F.slice("words", F.lit(1), F.col("first")), F.slice(F.flatten(cycle), F.lit(1), rest))
    return docs.select("doc_id", F.coalesce(F.array_join(cycled, " "), F.col("text")).alias("text"))


@query("op11_run_detection")
def op11(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's periodic runs of words, with cycles planted in a tenth of them, and its text without the repeats."""
    docs = _with_cycles(table(spark, sf, "documents").select("doc_id", "text"))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    spelled = F.concat(F.array_join(line, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    top = F.col("strongest")
    return rd.find_runs(docs).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        top["start"].alias("start"),
        top["length"].alias("length"),
        top["period"].alias("period"),
        F.expr("(1000 * strongest.length) div strongest.period").alias("exponent_milli"),
        F.sha2(spelled, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query("op12_huffman_token_file")
def op12(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's token ids, written to Huffman coded files by document id and read back from them."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    rows = written(tf.token_ids(docs, _tokenizer("byte_bpe_50k.json"), end_id=2), "token-ids")
    folder = session.shared_dir(spark, "token-files")
    tf.write(rows, folder)
    found = tf.read(spark, folder).select("doc_id", "n_tokens", F.crc32("ids").alias("ids_crc32"), "file", "inside")
    return tf.with_starts(found, folder).select("doc_id", "start", "n_tokens", "ids_crc32")


RANK_SQL = r"""
with folded as (
    select doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term, row
    from (select *, row_number() over () as row from documents)
), sizes as (
    select row, count(*) as n from folded group by row
), corpus as (
    select count(*) as docs, sum(n)::bigint as terms from sizes
), counted as (
    select row, any_value(doc_id) as doc_id, term, count(*) as tf from folded group by row, term
), weights as (
    select term, floor(1000 * ln((2 * any_value(docs) + 2)::double / (2 * count(*) + 1)))::bigint as w
    from counted, corpus group by term
), wanted as (
    select item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from benchmark
), scored as (
    select item_id, row, any_value(doc_id) as doc_id,
        sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms))))::bigint as score
    from wanted join counted using (term) join weights using (term) join sizes using (row), corpus
    group by item_id, row
), ranked as (
    select *, row_number() over (partition by item_id order by score desc, doc_id)::int as rank
    from scored where score > 0
)
select item_id, rank, doc_id, score from ranked where rank <= 20
"""


@query("op13_best_position_search", RANK_SQL)
def op13(spark: SparkSession, sf: str) -> DataFrame:
    """The 20 documents that score highest for the terms of every benchmark item."""
    return lr.rank(table(spark, sf, "documents"), table(spark, sf, "benchmark"), k=20)
