"""Broker topics as streams of records."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BOOTSTRAP = "kafka.bootstrap.servers"


def kafka_options(props: Mapping[str, str]) -> dict[str, str]:
    """Client properties as source options: bare keys get the `kafka.` prefix.

    The bootstrap address is never taken from here.
    """
    prefixed = {
        key if key.startswith("kafka.") else f"kafka.{key}": value for key, value in props.items()
    }
    prefixed.pop(BOOTSTRAP, None)
    return prefixed


def reader_options(
    bootstrap: str,
    topic: str,
    starting_offsets: str = "latest",
    options: Mapping[str, str] | None = None,
    max_offsets: int | None = None,
    fail_on_data_loss: bool | None = None,
) -> dict[str, str]:
    """Every option the broker source is started with."""
    if starting_offsets not in ("latest", "earliest"):
        raise ValueError("starting_offsets is 'latest' or 'earliest'")
    chosen = kafka_options(options or {})
    chosen.update(
        {BOOTSTRAP: bootstrap, "subscribe": topic, "startingOffsets": starting_offsets}
    )
    if max_offsets is not None:
        chosen["maxOffsetsPerTrigger"] = str(max_offsets)
    if fail_on_data_loss is not None:
        chosen["failOnDataLoss"] = str(fail_on_data_loss).lower()
    return chosen


def kafka_stream(spark: SparkSession, bootstrap: str, topic: str, **settings) -> DataFrame:
    """Subscribe to one topic; `settings` as in `reader_options`."""
    options = reader_options(bootstrap, topic, **settings)
    return spark.readStream.format("kafka").options(**options).load()


def record_envelope(records: DataFrame) -> DataFrame:
    """Broker metadata, key and value as text, and the ingest time."""
    return records.select(
        F.col("timestamp").alias("broker_ts"),
        "topic",
        "partition",
        "offset",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.current_timestamp().alias("ingest_ts"),
    )
