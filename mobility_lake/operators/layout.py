"""How rows are spread over files before a partitioned write."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lay_out(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Gather each output partition into few files, without giving a hot one to one task.

    The rebalance hint lets AQE merge small partitions and split a large one into
    several tasks of the advisory size.
    """
    if not partition_by:
        return df
    return df.hint("rebalance", *[F.col(name) for name in partition_by])


def one_file_each(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """One file per output partition, dealt over a fixed number of tasks.

    For rollups: they are small but have many partitions, so the cost is in opening
    files, and merging tasks by size would leave all of that to a single one.
    """
    if not partition_by:
        return df
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(tasks, *partition_by)


def lay_out_stream(df: DataFrame, partition_by: Sequence[str], files: int = 4) -> DataFrame:
    """The same for a streaming sink, where AQE does not re-plan: at most `files` per partition.

    Rows of a partition are dealt by a hash of the whole row, so a hot hour is written
    by `files` tasks.
    """
    deal = F.pmod(F.xxhash64(*df.columns), F.lit(files))
    return df.repartition(*[F.col(name) for name in partition_by], deal)
