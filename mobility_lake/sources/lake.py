"""Partitioned Parquet tables: batch and streaming reads, rebuilds, appends.

A rebuild writes a new version beside the old one and then points to it (see `versions`). Readers and
writers here resolve the pointer when they are called.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from mobility_lake.operators.layout import lay_out
from mobility_lake.sources.versions import current, names_in, publish

Layout = Callable[[DataFrame, Sequence[str]], DataFrame]

_NOTHING_THERE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def lake_read(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Batch scan. With a declared schema no file is opened to infer one, and only its columns come.

    A rebuild that ends meanwhile does not show: the version is chosen here.
    """
    path = current(spark, path)
    if schema is None:
        return spark.read.parquet(path)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def folder_name(column: str, value: object) -> str:
    """The folder of a partition value; dates and whole numbers only, which need no escaping."""
    if isinstance(value, bool) or not isinstance(value, (int, dt.date)) or isinstance(value, dt.datetime):
        raise ValueError(f"partition column {column!r} must hold dates or whole numbers")
    return f"{column}={value}"


def read_partitions(
    spark: SparkSession,
    path: str,
    partition_by: Sequence[str],
    partitions: Iterable[Sequence[object]],
    schema: T.StructType,
) -> DataFrame | None:
    """Those partitions of a table that exist, or None. Only the folders around them are listed.

    One listing of each parent tells which are there, so many partitions of a few days or months
    cost a few calls.
    """
    base = current(spark, path).rstrip("/")
    listed: dict[str, set[str]] = {}
    folders = []
    for values in partitions:
        place = base
        for column, value in zip(partition_by, values):
            name = folder_name(column, value)
            if place not in listed:
                listed[place] = names_in(spark, place)
            if name not in listed[place]:
                break
            place = f"{place}/{name}"
        else:
            folders.append(place)
    if not folders:
        return None
    reader = spark.read.schema(schema).option("basePath", base)
    return reader.parquet(*folders).select(*schema.names)


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """Schema of the data at `path`, or None when nothing is there yet."""
    try:
        return spark.read.parquet(current(spark, path)).schema
    except AnalysisException as error:
        if error.getCondition() in _NOTHING_THERE:
            return None
        raise


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there."""
    try:
        spark.read.format("binaryFile").load(path)
        return True
    except AnalysisException as error:
        if error.getCondition() in _NOTHING_THERE:
            return False
        raise


def lake_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    max_files: int | None = None,
    contract: T.StructType | None = None,
) -> DataFrame:
    """Parquet files as a stream, at most `max_files` per micro-batch.

    Without a declared schema the existing data lends its own, and an empty table falls
    back to `contract`. A stream stays with the version it started on; started again after a
    rebuild it takes all files of the new one as new.
    """
    path = current(spark, path)
    schema = schema or stored_schema(spark, path) or contract
    if schema is None:
        raise ValueError(f"no schema declared and nothing to borrow one from at {path}")
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def lake_rebuild(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), layout: Layout = lay_out
) -> None:
    """Replace the whole table in one step; until then, and if this fails, the old one stays."""

    def write(folder: str) -> None:
        writer = layout(df, partition_by).write
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(folder)

    publish(df.sparkSession, path, write)


def lake_replace_partitions(
    df: DataFrame, path: str, partition_by: Sequence[str], layout: Layout = lay_out
) -> None:
    """Replace only the partitions that `df` has rows for."""
    (
        layout(df, partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(current(df.sparkSession, path))
    )


def with_trigger(writer, trigger: Mapping[str, object] | None):
    """`{"processingTime": "30 seconds"}`, `{"availableNow": True}`, or None for back-to-back."""
    return writer.trigger(**trigger) if trigger else writer


def lake_append_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    trigger: Mapping[str, object] | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Append a stream to a table; the checkpoint makes a restart resume exactly."""
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name:
        writer = writer.queryName(name)
    return with_trigger(writer, trigger).start()


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Name a result for SQL."""
    df.createOrReplaceTempView(name)
    return df


def file_inventory(df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
    """Files, rows and bytes of a scanned table per partition. Reads no data columns."""
    per_file = (
        df.select(
            *partition_by,
            F.col("_metadata.file_path").alias("_path"),
            F.col("_metadata.file_size").alias("_size"),
        )
        .groupBy(*partition_by, "_path")
        .agg(F.count("*").alias("_rows"), F.max("_size").alias("_size"))
    )
    return per_file.groupBy(*partition_by).agg(
        F.count("*").alias("files"),
        F.sum("_rows").alias("records"),
        F.sum("_size").alias("bytes"),
    )
