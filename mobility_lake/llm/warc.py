"""Derived WARC records: link metadata and plain-text conversions made from responses.

For every response two records are derived, both with a `WARC-Refers-To` of the response's id
and its target and date: `metadata` (application/warc-fields: the HTTP status, the source's
content type, its payload digest, title, language and outgoing links) and `conversion`
(text/plain). Each has a block digest of its own. Everything is column expressions: a record
depends on one response only, so nothing is shuffled.

Ids are `urn:uuid` values made from the SHA-256 of what identifies the record, so a rerun
writes the same records.

Null html is an empty payload, a null url an empty target. A page without a title, language
or link has no such field. Repeated pages are the same record twice. An empty table gives no
records. Columns of the input pass through `derive`; columns named like a record's are replaced.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CRLF = "\r\n"

# Tags that end a line of text, and the named references that are resolved.
BLOCK_TAGS = (
    "address|article|aside|blockquote|body|br|caption|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|"
    "h1|h2|h3|h4|h5|h6|head|header|hr|html|li|main|nav|ol|option|p|pre|section|table|td|th|title|tr|ul"
)
REFERENCES = {
    "amp": "&",
    "lt": "<",
    "gt": ">",
    "quot": '"',
    "apos": "'",
    "nbsp": " ",
    "copy": "©",
    "reg": "®",
    "middot": "·",
    "hellip": "…",
    "ndash": "–",
    "mdash": "—",
}

# Regular expressions that mean the same to Java and to RE2.
HIDDEN = r"(?is)<(?:!--.*?--|script[\s>].*?</script\s*|style[\s>].*?</style\s*)>"
LINE_TAGS = rf"(?i)</?(?:{BLOCK_TAGS})(?:[\s/][^<>]*)?>"
OTHER_TAGS = r"<[!/?a-zA-Z][^<>]*>"
REFERENCE = r"^(#[0-9]{1,7}|[a-z]+);"
BLANKS = r"[ \t\r\f]+"
TITLE = r"(?is)<title[^<>]*>(.*?)</title\s*>"
LANGUAGE = r"(?i)<html[^<>]*\slang=\"([^\"<>]*)\""
LINK = r"(?i)<a\s[^<>]*?href=\"([^\"<>]*)\""


def resolved(text: Column) -> Column:
    """Character references as characters, each read once; unknown ones are left as they are."""
    names = F.create_map(*(F.lit(x) for pair in REFERENCES.items() for x in pair))

    def part(value: Column, at: Column) -> Column:
        name = F.regexp_extract(value, REFERENCE, 1)
        rest = F.substr(value, F.length(name) + 2)
        code = F.when(name.startswith("#"), F.substr(name, F.lit(2)).cast("int"))
        # Big-endian UTF-32 of any code point.
        letter = F.decode(F.unhex(F.lpad(F.hex(code.cast("long")), 8, "0")), "UTF-32")
        exists = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
        return (
            F.when(at == 0, value)
            .when(exists, F.concat(letter, rest))
            .when(F.map_contains_key(names, name), F.concat(names[name], rest))
            .otherwise(F.concat(F.lit("&"), value))
        )

    # The parts behind each "&" start with their name if it opens a reference.
    return F.when(
        F.contains(text, F.lit("&")), F.array_join(F.transform(F.split(text, "&"), part), "")
    ).otherwise(text)


def with_plain_text(pages: DataFrame, html: str, name: str) -> DataFrame:
    """The text of a page, a line per block, without scripts, styles and comments.

    A column per step: an expression that is used twice would be computed twice.
    """
    text, odd = F.col(name), [F.contains(F.col(name), F.lit(blank)) for blank in ("  ", "\t", "\r", "\f")]
    steps = (
        F.regexp_replace(
            F.regexp_replace(F.regexp_replace(F.col(html), HIDDEN, ""), LINE_TAGS, "\n"), OTHER_TAGS, ""
        ),
        resolved(text),
        # Most texts hold single blanks only and skip this one.
        F.when(reduce(or_, odd), F.regexp_replace(text, BLANKS, " ")).otherwise(text),
        F.btrim(F.regexp_replace(F.regexp_replace(text, "\n[\n ]+", "\n"), " \n", "\n"), F.lit(" \n")),
    )
    for step in steps:
        pages = pages.withColumn(name, step)
    return pages


def record_id(*parts: Column) -> Column:
    """A urn:uuid from a digest; equal parts give equal ids."""
    digest = F.sha2(F.concat_ws("\n", *parts), 256)
    pieces = [F.substring(digest, start, size) for start, size in ((1, 8), (9, 4), (14, 3), (18, 3), (21, 12))]
    a, b, c, d, e = pieces
    return F.concat(F.lit("<urn:uuid:"), a, F.lit("-"), b, F.lit("-8"), c, F.lit("-a"), d, F.lit("-"), e, F.lit(">"))


def responses(
    pages: DataFrame,
    url: str = "url",
    html: str = "html",
    date: str = "2024-01-01T00:00:00Z",
    content_type: str = "text/html; charset=utf-8",
) -> DataFrame:
    """Stored pages as response records: `target_uri`, `date`, `http`, `payload`, its digest, id."""
    payload, target = F.coalesce(F.col(html), F.lit("")), F.coalesce(F.col(url), F.lit(""))
    status = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: {content_type}{CRLF}Content-Length: "),
        F.octet_length(payload).cast("string"),
        F.lit(CRLF + CRLF),
    )
    digest = F.concat(F.lit("sha256:"), F.sha2(payload, 256))
    return pages.withColumns(
        {"target_uri": target, "date": F.lit(date), "http": status, "payload": payload}
    ).withColumns({"payload_digest": digest, "record_id": record_id(F.lit("response"), target, F.lit(date), digest)})


def _field(name: str, value: Column) -> Column:
    """A header line, or nothing for a null or empty value. Line ends inside become spaces."""
    one_line = F.trim(F.regexp_replace(value, r"\s+", " "))
    return F.when(one_line != "", F.concat(F.lit(f"{name}: "), one_line, F.lit(CRLF)))


def _block(*fields: Column) -> Column:
    return F.concat(*(F.coalesce(f, F.lit("")) for f in fields))


def derive(source: DataFrame, software: str = "mobility_lake/llm") -> DataFrame:
    """Two rows per response: `record_type`, `derived_id`, `refers_to`, `block`, `block_digest`,
    `content_type`, `content_length` and `header` (the record's header without its empty line)."""
    payload, http = F.col("payload"), F.col("http")
    source = with_plain_text(source, "payload", "_text").withColumn(
        "_title", F.regexp_extract(payload, TITLE, 1)
    )
    links = F.regexp_extract_all(payload, F.lit(LINK), F.lit(1))
    metadata = _block(
        _field("http-status", F.regexp_extract(http, r"^HTTP/[0-9.]+ ([0-9]{3})", 1)),
        _field("source-content-type", F.regexp_extract(http, r"(?i)\ncontent-type:[ \t]*([^\r\n]*)", 1)),
        _field("source-payload-digest", F.col("payload_digest")),
        _field("title", resolved(F.col("_title"))),
        _field("language", F.regexp_extract(payload, LANGUAGE, 1)),
        F.array_join(F.transform(links, lambda x: F.concat(F.lit("outlink: "), resolved(x), F.lit(CRLF))), ""),
    )
    kinds = F.array(
        F.struct(
            F.lit("metadata").alias("record_type"),
            F.lit("application/warc-fields").alias("content_type"),
            metadata.alias("block"),
        ),
        F.struct(
            F.lit("conversion").alias("record_type"),
            F.lit("text/plain; charset=utf-8").alias("content_type"),
            F.col("_text").alias("block"),
        ),
    )
    own = ("record_type", "content_type", "block")
    rows = source.drop(*own).withColumn("_kind", F.explode(kinds))
    rows = rows.withColumns({name: F.col(f"_kind.{name}") for name in own}).drop(
        "_kind", "_text", "_title"
    )
    rows = rows.withColumns(
        {
            "refers_to": F.col("record_id"),
            "block_digest": F.concat(F.lit("sha256:"), F.sha2("block", 256)),
            "content_length": F.octet_length("block").cast("long"),
            "derived_id": record_id(F.col("record_type"), F.col("record_id")),
        }
    )
    header = F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: "),
        F.col("record_type"),
        F.lit(f"{CRLF}WARC-Record-ID: "),
        F.col("derived_id"),
        F.lit(f"{CRLF}WARC-Refers-To: "),
        F.col("refers_to"),
        F.lit(f"{CRLF}WARC-Target-URI: "),
        F.col("target_uri"),
        F.lit(f"{CRLF}WARC-Date: "),
        F.col("date"),
        F.lit(f"{CRLF}WARC-Refers-To-Target-URI: "),
        F.col("target_uri"),
        F.lit(f"{CRLF}WARC-Refers-To-Date: "),
        F.col("date"),
        F.lit(f"{CRLF}WARC-Block-Digest: "),
        F.col("block_digest"),
        F.lit(f"{CRLF}X-Derived-By: {software}{CRLF}Content-Type: "),
        F.col("content_type"),
        F.lit(f"{CRLF}Content-Length: "),
        F.col("content_length").cast("string"),
    )
    return rows.withColumn("header", header)


def write_warc(records: DataFrame, path: str) -> None:
    """Write derived records as gzipped WARC files; two line ends close each record."""
    whole = F.concat("header", F.lit(CRLF + CRLF), "block")
    files = records.select(whole.alias("value")).write.option("lineSep", CRLF + CRLF)
    files.option("compression", "gzip").text(path)
