"""Deduplication by key, in batch and in streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_events(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = (),
    horizon: str | None = None,
    event_time: str = "event_ts",
) -> DataFrame:
    """One row per key. Rows with a NULL key belong in the rejects, not here.

    Batch: the smallest row in the order `order`, then all other columns, so the choice
    does not depend on how tasks ran. It is a plain aggregate: each task first reduces
    its own copies, so a key that holds a third of the table still sends one row per
    task to the shuffle. (A ranked window would send all copies to one task.)

    Stream: the first row to arrive; repeats are dropped while they lie within
    `horizon` of it. State is bounded by the horizon and later repeats are late rows.
    All copies of a key meet in one task, there is no reduction before that shuffle.
    Where late rows must not be lost or one key is hot, append everything and
    deduplicate in the recompute (`refresh_touched`), or at the sink (`append_new`).
    """
    if df.isStreaming:
        if horizon is None:
            raise ValueError("a stream needs a horizon, or its state grows without bound")
        return df.withWatermark(event_time, horizon).dropDuplicatesWithinWatermark(list(keys))
    ranked = [*order, *[name for name in df.columns if name not in {*keys, *order}]]
    if not ranked:
        return df.distinct()
    best = F.min(F.struct(*ranked)).alias("_best")
    return df.groupBy(*keys).agg(best).select(
        *[F.col(name) if name in keys else F.col("_best")[name].alias(name) for name in df.columns]
    )
