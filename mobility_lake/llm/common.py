"""Helpers that several operators share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import hashlib
import io
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import mobility_lake
from mobility_lake import session


def written(df: DataFrame, label: str) -> DataFrame:
    """`df` as a Parquet table in the shared folder: its lineage is cut and any executor can read it."""
    path = session.shared_dir(df.sparkSession, label)
    for paths in _NOTED:
        paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_NOTED: list[list[str]] = []


@contextlib.contextmanager
def noted() -> Iterator[list[str]]:
    """The folders that `written` makes inside the block."""
    paths: list[str] = []
    _NOTED.append(paths)
    try:
        yield paths
    finally:
        _NOTED.remove(paths)


def remove(spark: SparkSession, paths: Iterable[str]) -> None:
    """Remove folders of intermediate tables that nobody reads any more."""
    for place in paths:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def whole(text: str = "text") -> Column:
    """A text column with null read as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def lanes(spark: SparkSession) -> int:
    """How many pieces a shuffle of this session is dealt into."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _shared_copy(spark: SparkSession, content: bytes, name: str) -> str:
    """Path of a new file in the shared folder."""
    context, jvm = spark.sparkContext, spark.sparkContext._jvm
    place = f"{session.shared_dir(spark, 'files')}/{name}"
    path = jvm.org.apache.hadoop.fs.Path(place)
    out = path.getFileSystem(context._jsc.hadoopConfiguration()).create(path)
    try:
        out.write(bytearray(content))
    finally:
        out.close()
    return place


def shared_file(spark: SparkSession, content: bytes, name: str) -> str:
    """Put bytes into the shared folder and have Spark hand the file to every executor.

    Returns the name to give to `SparkFiles.get`. Executors that join later fetch it too.
    """
    name = f"{name}-{hashlib.sha256(content).hexdigest()[:24]}"
    handed = (spark.sparkContext.applicationId, name)
    if handed not in _HANDED:  # Spark refuses a second file of one name
        spark.sparkContext.addFile(_shared_copy(spark, content, name))
        _HANDED.add(handed)
    return name


_HANDED: set[tuple[str, str]] = set()
_SHIPPED: set[str] = set()


# Arrow batches are cut at this many bytes, so that long texts do not add up in a worker.
BATCH_BYTES = 4 << 20


def ship(spark: SparkSession) -> None:
    """Give the executors of this application the library, as `--py-files` would, and bound Arrow batches."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    application = spark.sparkContext.applicationId
    if application in _SHIPPED:
        return
    root = Path(mobility_lake.__file__).parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for source in sorted(root.rglob("*.py")):
            archive.write(source, source.relative_to(root.parent))
    name = f"mobility_lake-{hashlib.sha256(packed.getvalue()).hexdigest()[:16]}.zip"
    spark.sparkContext.addPyFile(_shared_copy(spark, packed.getvalue(), name))
    _SHIPPED.add(application)


def by_bytes(batches: Iterable[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that a text column stays near `most` bytes; a longer text is alone.

    A worker outlives its task, so what the batches used goes back to the system behind the last.
    """
    pa.set_memory_pool(pa.system_memory_pool())
    for batch in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
        ends = np.cumsum(sizes)
        start = 0
        while start < len(sizes):
            base = ends[start] - sizes[start]
            stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
    give_back()


def give_back() -> None:
    """Return freed memory of this process to the system, where the C library can."""
    gc.collect()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def gathered(batches: Iterable[pa.RecordBatch], column: str, least: int) -> Iterator[pa.RecordBatch]:
    """Arrow batches put together until a text column has `least` bytes."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += pc.sum(pc.binary_length(batch.column(column))).as_py() or 0
        if size >= least:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """A text column as Python strings, null read as empty."""
    return pc.fill_null(batch.column(column), "").to_pylist()


def spliced(parts: list[bytes], index: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """4-byte values of `parts[i]` for each i of `index`, in a row, and where each list that
    `offsets` cuts from `index` begins and ends in it."""
    sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
    starts = np.cumsum(sizes) - sizes
    flat = np.frombuffer(b"".join(parts), "<i4")
    each = sizes[index]
    ends = np.cumsum(each)
    total = int(ends[-1]) if len(ends) else 0
    at = np.repeat(starts[index] - (ends - each), each) + np.arange(total)
    return flat[at], np.concatenate([[0], ends])[offsets]
