"""Load into a typed contract by column name."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from mobility_lake.sources.lake import lake_append_stream, lake_stream


def _matches(
    df: DataFrame, target: T.StructType, sources: Mapping[str, str] | None
) -> dict[str, str | None]:
    by_lower: dict[str, str] = {}
    for name in df.columns:
        if name.lower() in by_lower:
            raise ValueError(f"columns {by_lower[name.lower()]!r} and {name!r} differ only in case")
        by_lower[name.lower()] = name
    wanted = {field.name: (sources or {}).get(field.name, field.name) for field in target}
    return {name: by_lower.get(source.lower()) for name, source in wanted.items()}


def load_by_name(
    df: DataFrame,
    target: T.StructType,
    sources: Mapping[str, str] | None = None,
    keep: Mapping[str, str] | None = None,
) -> DataFrame:
    """The columns of `target`, matched by case-insensitive name.

    Target columns without a match are NULL, other source columns are dropped.
    `sources` names the source column of a target column that is spelled differently; `keep`
    names columns to carry along, by their new name.
    """
    matches = _matches(df, target, sources)
    return df.select(
        *[F.col(column).alias(name) for name, column in (keep or {}).items()],
        *[
            (F.col(matches[field.name]) if matches[field.name] else F.lit(None))
            .cast(field.dataType)
            .alias(field.name)
            for field in target
        ]
    )


def load_report(
    df: DataFrame, target: T.StructType, sources: Mapping[str, str] | None = None
) -> dict[str, list[str]]:
    """What a load would leave NULL and what it would drop."""
    matches = _matches(df, target, sources)
    used = set(matches.values())
    return {
        "unfilled": [name for name, source in matches.items() if source is None],
        "dropped": [name for name in df.columns if name not in used],
    }


def load_new_files(
    spark: SparkSession,
    source: str,
    path: str,
    checkpoint: str,
    target: T.StructType,
    sources: Mapping[str, str] | None = None,
    schema: T.StructType | None = None,
) -> StreamingQuery:
    """Load every file at `source` that was not loaded before, then stop.

    For sources that only add files. Where a refresh rewrites them, a rewritten file would be loaded
    again: `feeds.start_landing` replaces the rows of the hours that changed instead.
    """
    incoming = lake_stream(spark, source, schema)
    loaded = load_by_name(incoming, target, sources)
    return lake_append_stream(loaded, path, checkpoint, trigger={"availableNow": True})
