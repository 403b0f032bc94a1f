import gzip
import pathlib

from pyspark.sql import functions as F

from mobility_lake.llm import warc

PAGE = (
    '<!DOCTYPE html><html lang="en"><head><title>T &amp; &#65;</title><style>p{}</style><script>var t="</p>";</script>'
    '</head><body><!-- no\nthing --><a href="/x?a=1&amp;b=2">link</a><p>One  two<br>three &lt;b&gt; &unknown; &amp;lt;</p></body></html>'
)


def derived(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, block string")
    return warc.derive(warc.responses(pages))


def test_records_are_linked_and_read_well(spark):
    rows = {r["record_type"]: r for r in derived(spark, [(1, "http://e/x", PAGE, "old")]).collect()}
    text, metadata = rows["conversion"], rows["metadata"]
    assert text["block"] == "T & A\nlink\nOne two\nthree <b> &unknown; &lt;"
    assert "title: T & A\r\n" in metadata["block"] and "outlink: /x?a=1&b=2\r\n" in metadata["block"]
    assert text["refers_to"] == metadata["refers_to"] != text["derived_id"] != metadata["derived_id"]
    assert f"WARC-Refers-To: {text['refers_to']}\r\n" in text["header"]
    assert text["content_length"] == len(text["block"].encode())


def test_odd_pages(spark):
    rows = [(1, None, None, ""), (2, "u", "", ""), (3, "u", "no tags < 3", ""), (3, "u", "no tags < 3", ""), (4, "u", "<p>&#0;&#1114112;&#55296;&#128512;", "")]
    found = derived(spark, rows).filter("record_type = 'conversion'").collect()
    blocks = sorted((r["page_id"], r["block"]) for r in found)
    assert blocks == [(1, ""), (2, ""), (3, "no tags < 3"), (3, "no tags < 3"), (4, "&#0;&#1114112;&#55296;\U0001f600")]
    assert len({r["derived_id"] for r in found if r["page_id"] == 3}) == 1
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.derive(warc.responses(empty)).collect() == []


def test_written_files_hold_whole_records(spark, folder):
    records = derived(spark, [(i, f"http://e/{i}", PAGE, "") for i in range(5)])
    warc.write_warc(records, f"{folder}/warc")
    raw = b"".join(gzip.open(p).read() for p in pathlib.Path(f"{folder}/warc").glob("*.gz"))
    seen = 0
    while raw:
        head, _, rest = raw.partition(b"\r\n\r\n")
        length = int(head.rpartition(b"Content-Length: ")[2])
        assert head.startswith(b"WARC/1.1\r\nWARC-Type: ") and rest[length : length + 4] == b"\r\n\r\n"
        raw, seen = rest[length + 4 :], seen + 1
    assert seen == 10 == records.select(F.count(F.lit(1))).first()[0]
