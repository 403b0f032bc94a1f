"""The region dimension from JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mobility_lake.contracts import REGIONS
from mobility_lake.operators.quality import REASON, missing, split_rejects


def load_regions(
    spark: SparkSession, path: str, array: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(valid regions, rejects). A region needs all of its five fields and an id of its own.

    Of regions that share an id the first by city, label and place stays, the others are rejected as
    repeated, so a join on the id never multiplies observations.
    `array=True` reads one JSON array per file; a file is then read by one task, which
    suits a hand-kept list. `array=False` reads one object per line and splits freely.
    """
    regions = spark.read.schema(REGIONS).option("multiLine", array).json(path)
    return valid_regions(regions)


def valid_regions(regions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid regions, rejects) of a frame with the region fields."""
    marked, incomplete = split_rejects(regions, {"incomplete": missing(*REGIONS.names)})
    names = [name for name in REGIONS.names if name != "region_id"]
    # Equal rows once with their number, and the row of each id that stays; no id meets in one task
    # with all of its rows.
    distinct = marked.groupBy(*REGIONS.names).agg(F.count("*").alias("_copies"))
    kept = marked.groupBy("region_id").agg(F.min(F.struct(*names)).alias("_kept"))
    valid = kept.select("_kept.*", "region_id").select(*REGIONS.names)
    stays = (F.struct(*names) == F.col("_kept")).cast("int")
    surplus = F.array_repeat(F.lit("repeated id"), (F.col("_copies") - stays).cast("int"))
    repeated = distinct.join(kept, "region_id").select(*REGIONS.names, F.explode(surplus).alias(REASON))
    return valid, incomplete.unionByName(repeated)
