"""Session settings every job relies on, and the shared folder for written intermediates."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import SparkSession

# Set at start-up; a session made elsewhere keeps its own values for these.
BUILD_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Merged or split shuffle partitions, and with them the files of a rebalanced table.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Dedup and window state is kept off the JVM heap and checkpointed as deltas.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Results depend on these two, so they are set on any session that is handed in:
# hour buckets follow the zone, and ANSI turns an overflowing sum into an error.
PINNED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def build(app_name: str = "mobility-lake", **conf: str) -> SparkSession:
    """Start (or get) a session with the library's settings; `conf` uses `__` for dots."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**BUILD_CONF, **PINNED_CONF}.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shuffle_partitions(shuffled_bytes: int, cores: int, target_bytes: int = 128 << 20) -> int:
    """Value for `spark.sql.shuffle.partitions` that keeps a reducer near `target_bytes`.

    AQE merges partitions that turn out small but never makes more of them, so a job that
    shuffles terabytes must start with enough. A stream keeps the number it first ran with.
    """
    return max(2 * cores, math.ceil(shuffled_bytes / target_bytes))


def pin(spark: SparkSession) -> SparkSession:
    """Set the result-relevant settings on an existing session."""
    for key, value in PINNED_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new folder for a written intermediate, visible to every executor.

    The cluster names the place in `spark.checkpoint.dir`. A session that runs in one process
    and does not name one uses its warehouse, which every part of it sees.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/intermediate"
    return f"{base.rstrip('/')}/mobility_lake/{label}-{uuid.uuid4().hex}"
