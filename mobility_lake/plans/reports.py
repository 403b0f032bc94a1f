"""What a dashboard reads from the daily operations mart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mobility_lake.functions.values import rounded_mean, rounded_total
from mobility_lake.operators.quality import complete_pairs


def mart_read(spark: SparkSession, name: str, date: str = "date") -> DataFrame:
    """A named mart in date order."""
    return spark.table(name).orderBy(date)


def ordered(mart: DataFrame, desc: bool = False, date: str = "date") -> DataFrame:
    """The mart by date."""
    return mart.orderBy(F.desc(date) if desc else F.asc(date))


def preview(df: DataFrame, n: int = 20, by: Sequence[str] | None = None) -> DataFrame:
    """The first n rows under the order `by`, then all other columns."""
    first = list(by or [])
    return df.orderBy(*first, *[name for name in df.columns if name not in first]).limit(n)


def date_bounds(mart: DataFrame, date: str = "date") -> DataFrame:
    """First and last date."""
    return mart.agg(F.min(date).alias("first_date"), F.max(date).alias("last_date"))


def kpis(mart: DataFrame) -> DataFrame:
    """Total trips and revenue, mean of the daily tickets and temperatures."""
    return mart.agg(
        F.sum("total_trips").alias("total_trips"),
        rounded_total("revenue").alias("revenue"),
        rounded_mean("mean_ticket").alias("mean_ticket"),
        rounded_mean("mean_temperature").alias("mean_temperature"),
    )


def series(mart: DataFrame, measure: str, drop_null: bool = False) -> DataFrame:
    """One measure by date, optionally without the days that lack it."""
    points = mart.select("date", measure)
    if drop_null:
        points = points.dropna(subset=[measure])
    return points.orderBy("date")


def pairs(mart: DataFrame, x: str, y: str) -> DataFrame:
    """Complete (x, y) pairs for a scatter plot; none at all unless there are at least two."""
    complete = complete_pairs(mart, [x, y])
    # A subquery of the plan: nothing runs before the result is asked for.
    return complete.filter(complete.select(F.count("*")).scalar() > 1)


def detail_table(mart: DataFrame) -> DataFrame:
    """The mart with a date-typed day."""
    return mart.withColumn("date", F.to_date("date")).orderBy("date")
