"""Token ids in binary files: canonical Huffman blocks that decode apart, with checkpoints.

A folder holds `blocks` (binary files, written by Spark in ascending order of document id),
`codebook` (bits of every id's code, from the counts of all ids) and `manifest` (one row per
file: its number, documents, ids, and the ids of all files before it).

A file is a list of records, each with a line end behind it: blocks, then one trailer. All numbers
are little-endian. A block starts with `BLOCK`: its mark, documents, ids, ids before it in the
file, ids between two checkpoints, checkpoints, bytes of the stream. Then come for every
document its id (8 bytes), its number of ids (8 bytes) and whether its id is null (1 byte), 8
bytes per checkpoint (the bit offset of the first and then of every so many ids of a document) and
the stream. The trailer has its mark, documents and ids of the file. Files are cut by ids, so a
block or a file can be read, and decoded by the table of the codebook, without any other.

Texts become ids as the `tokenizers` library has them for a byte-level BPE file; a word is
encoded once and then found in a cache of bounded size.

Defined results: null and empty texts are the end id alone. Rows of one document id, also
of a null one, which comes first, go by their number of ids and a hash of them; repeated
rows are kept as often as they come. Of the input only the id and text columns are used, so other
columns may have any name. An empty table gives a folder that reads as an empty table.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mobility_lake.llm.bpe import Vocabulary
from mobility_lake.llm.common import by_bytes, gathered, written
from mobility_lake.llm.huffman import Code, code_lengths, limit_for, pack, unpack
from mobility_lake.llm.word_ids import WordIds

BLOCK = struct.Struct("<4sqqqqqq")
TRAILER = struct.Struct("<4sqq")
BLOCK_MARK, TRAILER_MARK = b"TKB1", b"TKE1"
BLOCK_IDS = 1 << 18
FILE_IDS = 1 << 23
EVERY = 256  # ids between checkpoints
BATCH = 12 << 20  # bytes of text at a time
GROUP = 4096  # files whose sizes are summed together


_WORD_IDS: dict[str, WordIds] = {}


def _word_ids(path: str) -> WordIds:
    """One per worker process."""
    if path not in _WORD_IDS:
        _WORD_IDS[path] = WordIds(path)
    return _WORD_IDS[path]


def token_ids(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", end_id: int = 2) -> DataFrame:
    """(doc_id long, place long, n_tokens long, ids binary): every text's ids and the end id.

    `place` numbers the rows; `ids` has 2 bytes per id where the vocabulary allows it, else 4.
    """
    vocabulary = Vocabulary(path)
    kind = "<u2" if max(end_id, *vocabulary.token_bytes) < 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _word_ids(path)
        for batch in by_bytes(gathered(batches, "text", BATCH), "text", BATCH):
            flat, ends = encoder(batch.column("text"))
            flat = np.insert(flat, ends[1:], end_id).astype(kind)
            sizes = np.diff(ends) + 1
            starts = (np.concatenate([[0], np.cumsum(sizes)]) * flat.itemsize).astype(np.int32)
            ids = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(starts), pa.py_buffer(flat)])
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("place"), pa.array(sizes), ids],
                names=["doc_id", "place", "n_tokens", "ids"],
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = rows.withColumn("place", F.monotonically_increasing_id())
    return rows.mapInArrow(run, "doc_id long, place long, n_tokens long, ids binary")


def _numbers(column: pa.Array, sizes: np.ndarray) -> np.ndarray:
    """The ids of a batch in a row; their width follows from the numbers of ids."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    total = int(sizes.sum())
    raw = column.buffers()[2] if total else b""
    width = int(offsets[-1] - offsets[0]) // total if total else 2
    return np.frombuffer(raw, f"<u{width}", total, int(offsets[0]) if total else 0)


def _sizes(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("n_tokens").to_numpy(zero_copy_only=False).astype(np.int64)


def count_ids(rows: DataFrame) -> DataFrame:
    """(id long, n long): how often each id occurs in all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            found = np.bincount(_numbers(batch.column("ids"), _sizes(batch)))
            if len(found) < len(total):
                total[: len(found)] += found
            else:
                found[: len(total)] += total
                total = found
        ids = np.flatnonzero(total)
        yield pa.record_batch([pa.array(ids), pa.array(total[ids])], names=["id", "n"])

    return rows.select("n_tokens", "ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write(rows: DataFrame, path: str, file_ids: int = FILE_IDS, every: int = EVERY) -> None:
    """Write a table of `token_ids`, which is read three times and so should be a written one, as a folder.

    The driver sees a count per id of the vocabulary. Rows are dealt into files by ranges of
    (id, number of ids, hash, place), so a document id with many rows may span files; a file holds
    about `file_ids` ids and each document whole.
    """
    spark = rows.sparkSession
    counted = sorted((r["id"], r["n"]) for r in count_ids(rows).collect())
    ids, counts = np.array(counted, np.int64).reshape(-1, 2).T
    lengths = code_lengths(counts, limit_for(len(ids)))
    book = spark.createDataFrame(list(zip(ids.tolist(), lengths.tolist())), "id long, bits long")
    book.coalesce(1).write.parquet(f"{path}/codebook")
    codes, bits = Code(ids, lengths).encoder()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents = numbers = held = 0
        own: list[pa.RecordBatch] = []
        for batch in batches:
            ends = np.cumsum(_sizes(batch))
            start = 0
            while start < len(ends):
                base = int(ends[start - 1]) if start else 0
                stop = int(np.searchsorted(ends, base + BLOCK_IDS - held, side="left")) + 1
                own.append(part := batch.slice(start, stop - start))
                held += int(ends[min(stop, len(ends)) - 1]) - base
                documents += len(part)
                start = stop
                if held >= BLOCK_IDS:
                    yield _record(_block(own, numbers, codes, bits, every))
                    numbers, held, own = numbers + held, 0, []
        if held:
            yield _record(_block(own, numbers, codes, bits, every))
        if documents:
            yield _record(_trailer(documents, numbers + held))

    files = max(1, math.ceil(int(counts.sum()) / file_ids))
    order = [F.asc_nulls_first("doc_id"), F.col("n_tokens"), F.col("hash"), F.col("place")]
    dealt = rows.withColumn("hash", F.xxhash64("ids")).repartitionByRange(files, *order).sortWithinPartitions(*order)
    records = dealt.select("doc_id", "n_tokens", "ids").mapInArrow(blocks, "record binary")
    # The text writer puts down the bytes of a string as they are, and a line end.
    writer = records.select(F.col("record").cast("string").alias("value")).write
    writer.option("lineSep", "\n").option("maxRecordsPerFile", 0).option("compression", "none").text(f"{path}/blocks")
    _manifest(spark, path).write.parquet(f"{path}/manifest")


def _record(raw: bytes) -> pa.RecordBatch:
    return pa.record_batch([pa.array([raw], pa.binary())], names=["record"])


def _trailer(documents: int, ids: int) -> bytes:
    return TRAILER.pack(TRAILER_MARK, documents, ids)


def _block(own: list[pa.RecordBatch], before: int, codes: np.ndarray, bits: np.ndarray, every: int) -> bytes:
    sizes = np.concatenate([_sizes(b) for b in own])
    stream, offsets = pack(np.concatenate([_numbers(b.column("ids"), _sizes(b)) for b in own]), codes, bits)
    points = offsets[_pieces(sizes, every)[0]]
    names = pa.concat_arrays([b.column("doc_id") for b in own])
    head = BLOCK.pack(BLOCK_MARK, len(sizes), int(sizes.sum()), before, every, len(points), len(stream))
    ids = np.asarray(pc.fill_null(names, 0), dtype="<i8")
    return b"".join(
        [head, ids.tobytes(), sizes.astype("<i8").tobytes(), np.asarray(names.is_null()).astype("u1").tobytes()]
        + [points.astype("<i8").tobytes(), stream]
    )


def _pieces(sizes: np.ndarray, every: int) -> tuple[np.ndarray, np.ndarray]:
    """(first id, ids) of the pieces between checkpoints, for documents of these sizes in a row."""
    many = -(-sizes // every)
    nth = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
    first = np.repeat(np.cumsum(sizes) - sizes, many) + nth * every
    return first, np.minimum(every, np.repeat(sizes, many) - nth * every)


def _files(spark: SparkSession, path: str) -> DataFrame:
    """(file long, content binary) of the block files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/blocks")
    number = F.regexp_extract(F.element_at(F.split("path", "/"), -1), r"^part-(\d+)", 1)
    return files.filter("length > 0").select(number.cast("long").alias("file"), "content")


def _manifest(spark: SparkSession, path: str) -> DataFrame:
    """(file, documents, ids, before): from the trailers; sizes are summed in groups of files first."""

    size = TRAILER.size + 1
    tail = _files(spark, path).withColumn("content", F.expr(f"substring(content, -{size}, {size})"))
    little = [F.conv(F.hex(F.expr(f"substring(content, {at + i}, 1)")), 16, 10).cast("long") for at in (5, 13) for i in range(8)]
    total = [sum((little[8 * k + i] * (1 << 8 * i) for i in range(8)), F.lit(0)) for k in (0, 1)]
    sizes = written(tail.select("file", total[0].alias("documents"), total[1].alias("ids")), "sizes")
    sizes = sizes.withColumn("group", F.floor(F.col("file") / GROUP))
    groups = sizes.groupBy("group").agg(F.sum("ids").alias("all"))
    groups = groups.select("group", (F.sum("all").over(Window.orderBy("group")) - F.col("all")).alias("ahead"))
    inside = F.sum("ids").over(Window.partitionBy("group").orderBy("file")) - F.col("ids")
    return sizes.withColumn("inside", inside).join(groups, "group").select(
        "file", "documents", "ids", (F.col("ahead") + F.col("inside")).alias("before")
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id long, n_tokens long, ids binary, file long, inside long): the documents of a folder.

    `ids` has 4 bytes per id, little-endian and unsigned; `inside` counts the ids before it in its file.
    """
    book = sorted((r["id"], r["bits"]) for r in spark.read.parquet(f"{path}/codebook").collect())
    ids, lengths = np.array(book, np.int64).reshape(-1, 2).T

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(ids, lengths)
        table = code.table()
        for batch in batches:
            for number, content in zip(batch.column("file").to_pylist(), batch.column("content")):
                raw, at = memoryview(content.as_buffer()), 0
                while bytes(raw[at : at + 4]) == BLOCK_MARK:
                    out, at = _read_block(raw, at, table, code.limit)
                    names, sizes, found, inside = out
                    starts = (np.concatenate([[0], np.cumsum(sizes)]) * 4).astype(np.int32)
                    listed = pa.Array.from_buffers(
                        pa.binary(), len(sizes), [None, pa.py_buffer(starts), pa.py_buffer(found.astype("<u4"))]
                    )
                    files = pa.array(np.full(len(sizes), number, np.int64))
                    columns = [names, pa.array(sizes), listed, files, pa.array(inside)]
                    yield pa.record_batch(columns, names=["doc_id", "n_tokens", "ids", "file", "inside"])

    schema = "doc_id long, n_tokens long, ids binary, file long, inside long"
    return _files(spark, path).mapInArrow(decode, schema)


def _read_block(raw: memoryview, at: int, table: np.ndarray, limit: int):
    """((document ids, sizes, ids, ids before each in the file), where the next record starts)."""
    _, documents, _, before, every, points, size = BLOCK.unpack_from(raw, at)
    at += BLOCK.size
    names, sizes = (np.frombuffer(raw, "<i8", documents, at + k * 8 * documents) for k in (0, 1))
    at += 16 * documents
    none = np.frombuffer(raw, "u1", documents, at).astype(bool)
    offsets = np.frombuffer(raw, "<i8", points, at + documents)
    at += documents + 8 * points
    words = np.frombuffer(bytes(raw[at : at + size]) + bytes(16 - size % 8), ">u8").astype(np.uint64)
    found = unpack(words, offsets, _pieces(sizes, every)[1], table, limit)
    return (pa.array(names, mask=none), sizes, found, before + np.cumsum(sizes) - sizes), at + size + 1


def with_starts(rows: DataFrame, path: str) -> DataFrame:
    """Rows of `read`, best without their ids, with `start`: the ids of all documents before."""
    manifest = rows.sparkSession.read.parquet(f"{path}/manifest").select("file", "before")
    return rows.join(manifest, "file").withColumn("start", F.col("before") + F.col("inside")).drop("before")
