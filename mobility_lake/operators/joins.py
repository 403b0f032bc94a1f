"""Attach attributes of a dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_region(
    observations: DataFrame, regions: DataFrame, on: str = "region_id"
) -> DataFrame:
    """Attach region attributes as `region_*`; observations without a region are kept.

    No broadcast hint: Spark broadcasts the dimension while its size is under
    `spark.sql.autoBroadcastJoinThreshold` and otherwise sort-merges, where AQE splits
    a hot region. Works for a static frame and for a stream of observations.
    """
    attributes = regions.select(
        F.col(on),
        *[
            F.col(name).alias(f"region_{name}")
            for name in regions.columns
            if name != on
        ],
    )
    return observations.join(attributes, on, "left")
