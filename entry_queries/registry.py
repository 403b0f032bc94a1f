"""Every registered query: name, Spark callable, and the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mobility_lake import session

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def _zone_free(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, so a reader in any zone sees the same value."""
    zoned = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without `sql` only its rows are checked."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf: str) -> DataFrame:
            return _zone_free(build(session.pin(spark), sf))

        run.__name__ = name
        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return build

    return register
