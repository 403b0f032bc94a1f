"""An index of all keys a long-lived stream has seen, whose reads stay flat.

The index is a table of runs (`sources.runs`): each micro-batch adds a run of its new keys, and runs
are merged by levels. A run holds its keys in parts by the leading bits of their hash, and a
Bloom filter of them: two bits per key in a bitmap of 16 to 32 bits per key, as rows of 4 KB that
Spark's own bitmap aggregate makes. A look-up tests all filters, which lie in one file per run,
and then reads the parts that may hold a key: none for almost all keys that are new.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mobility_lake.sources import runs
from mobility_lake.sources.runs import Run

HASH = "_hash"
BITS_PER_KEY = 16
PART_KEYS = 1 << 20
_ROW_BITS = 15  # a row of a bitmap aggregate has 2 ** 15 bits


def _log2(number: float) -> int:
    """Bits that count up to `number`, 0 for one or less."""
    return max(0, int(number - 1).bit_length()) if number > 1 else 0


def _part(hashed: Column, bits: int) -> Column:
    return (F.shiftrightunsigned(hashed, 64 - bits) if bits else F.lit(0)).cast("int")


def _places(hashed: Column, bits: Column) -> Column:
    """The two positions of a key in a filter of 2 ** bits bits, counted from 1."""
    mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), bits) - 1
    return F.array(hashed.bitwiseAND(mask) + 1, F.xxhash64(hashed).bitwiseAND(mask) + 1)


def _write(rows: DataFrame, keys: Sequence[str], count: int, folder: str) -> dict:
    """A run of `count` distinct keys; returns its notes."""
    bits, parts = max(_ROW_BITS, _log2(BITS_PER_KEY * count)), _log2(count / PART_KEYS)
    if not count:
        return {"keys": 0, "bits": bits, "parts": parts}
    hashed = rows.select(*keys).withColumn(HASH, F.xxhash64(*keys))
    dealt = hashed.withColumn("part", _part(F.col(HASH), parts)).repartition(1 << parts, "part")
    dealt.sortWithinPartitions("part", HASH).write.partitionBy("part").parquet(f"{folder}/keys")
    stored = rows.sparkSession.read.parquet(f"{folder}/keys")
    place = stored.select(F.explode(_places(F.col(HASH), F.lit(bits))).alias("place"))
    filters = place.groupBy(F.bitmap_bucket_number("place").alias("number")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bitmap")
    )
    filters = filters.withColumn("run", F.lit(folder.rsplit("/", 1)[-1]))
    # Rows of 4 KB: one file up to 16 million keys.
    files = 1 << _log2(2.0 ** (bits - 28))
    filters.repartitionByRange(files, "number").sortWithinPartitions("number").write.parquet(f"{folder}/filter")
    return {"keys": count, "bits": bits, "parts": parts}


def add(rows: DataFrame, keys: Sequence[str], path: str, batch: int) -> None:
    """Add the keys of `rows`, which are distinct, as the run of a micro-batch."""
    spark, count = rows.sparkSession, rows.count()
    if count:
        runs.add(spark, path, batch, lambda folder: _write(rows, keys, count, folder))


def rebuild(rows: DataFrame, keys: Sequence[str], path: str, batch: int = -1) -> None:
    """Make the distinct keys of `rows` the whole index."""
    found = rows.select(*keys).distinct()
    count = found.count()
    runs.replace_all(rows.sparkSession, path, batch, lambda folder: _write(found, keys, count, folder))


def merge(spark: SparkSession, keys: Sequence[str], path: str, before: int, fan: int = runs.FAN) -> int:
    """Merge full levels of the batches below `before`. Keys of different runs are distinct already."""

    def write(chosen: Sequence[Run], folder: str) -> dict:
        chosen = [run for run in chosen if run.notes["keys"]]
        rows = spark.read.parquet(*runs.folders(path, chosen, "keys/*"))
        return _write(rows, keys, sum(run.notes["keys"] for run in chosen), folder)

    return runs.merge(spark, path, write, before, fan)


def candidates(rows: DataFrame, keys: Sequence[str], path: str, live: Sequence[Run]) -> DataFrame:
    """(run, hash) of the keys of `rows` that the filters of these runs let through."""
    spark = rows.sparkSession
    listed = F.array(*[F.struct(F.lit(r.name).alias("run"), F.lit(r.notes["bits"]).alias("bits")) for r in live])
    asked = rows.select(F.xxhash64(*keys).alias(HASH)).distinct().select(HASH, F.explode(listed).alias("r"))
    asked = asked.select(HASH, "r.run", F.explode(_places(F.col(HASH), F.col("r.bits"))).alias("place"))
    asked = asked.select(
        HASH, "run", F.bitmap_bucket_number("place").alias("number"), F.bitmap_bit_position("place").alias("bit")
    )
    filters = spark.read.schema("number bigint, bitmap binary, run string").parquet(*runs.folders(path, live, "filter"))
    byte = F.conv(F.hex(F.expr("substring(bitmap, cast(bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
    is_set = F.call_function("shiftright", byte, (F.col("bit") % 8).cast("int")).bitwiseAND(F.lit(1)) == 1
    hits = asked.join(filters, ["run", "number"]).filter(is_set)
    return hits.groupBy("run", HASH).count().filter("count = 2").select("run", HASH)


def known(rows: DataFrame, keys: Sequence[str], path: str, batch: int) -> DataFrame | None:
    """Keys of the parts of the index that may hold a key of `rows`, those of the batch itself left out.

    None if no part does, or there is no index yet. The parts found are collected: they are at most as
    many as there are files, and few when keys are new.
    """
    spark = rows.sparkSession
    live = [run for run in runs.live(spark, path) if run.level > 0 or run.batch != batch]
    live = [run for run in live if run.notes["keys"]]
    if not live:
        return None
    bits = {run.name: run.notes["parts"] for run in live}
    found = candidates(rows, keys, path, live)
    parts = F.coalesce(*[F.when(F.col("run") == name, _part(F.col(HASH), own)) for name, own in bits.items()])
    touched = found.select("run", parts.alias("part")).distinct().collect()
    if not touched:
        return None
    places = {run.name: place for run, place in zip(live, runs.folders(path, live, "keys"))}
    schema = rows.select(*keys).schema
    return spark.read.schema(schema).parquet(*sorted(f"{places[r['run']]}/part={r['part']}" for r in touched))
