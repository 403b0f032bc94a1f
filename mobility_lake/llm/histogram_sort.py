"""Sharding by histogram sort.

Rows are ordered by a 128-bit key: the hash of a group (rows of one group are neighbours) and
then the hash of a row id. Cut points between shards are found by counting, in every round,
the exact bytes below evenly spaced candidate keys: each count is one aggregate over two longs
and a size, of which the driver sees at most 1,024 sums per unsettled cut. Only the interval
that holds a target is probed again, until the bytes below a candidate are within the
tolerance of the target or the interval holds a single key. Then rows move once.

A group larger than the tolerance is cut by row id, so one text that makes up a third of the
table still spreads over its shards; smaller groups stay whole.

Rows equal in both hashes cannot be told apart and stay together. Null groups and ids hash
like any value. An empty table gives an empty result. Columns of the input pass through; the
names `shard` and `slot` and those that start with `_` are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mobility_lake.llm.common import lanes, written

# Bits of the key settled after each round; a round never reaches over the border of the two longs.
DEPTHS = (0, 10, 20, 30, 40, 50, 60, 64, 74, 84, 94, 104, 114, 124, 128)
SIGN = -(1 << 63)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _bits(first: int, last: int) -> Column:
    """Bits [first, last) of the key as a number, counted from the top of one of its longs."""
    column, start = ("_high", 0) if last <= 64 else ("_low", 64)
    value = F.col(column)
    if last - start < 64:
        value = F.shiftrightunsigned(value, 64 + start - last)
    width = last - first
    return value if width >= 64 else value.bitwiseAND(F.lit((1 << width) - 1))


def _inside(prefix: int, depth: int) -> Column:
    """Whether a key starts with these bits."""
    if depth == 0:
        return F.lit(True)
    if depth <= 64:
        return _bits(0, depth) == F.lit(_signed(prefix) if depth == 64 else prefix)
    low = depth - 64
    return (F.col("_high") == F.lit(_signed(prefix >> low))) & (
        _bits(64, depth) == F.lit(prefix & ((1 << low) - 1))
    )


@dataclass
class _Cut:
    target: float
    prefix: int = 0
    below: int = 0
    key: int | None = None  # settled: rows with a key of at least this go to the right


def splitters(keys: DataFrame, shards: int, tolerance: float) -> list[int]:
    """`shards` - 1 cut points over a table of `_high`, `_low`, `_bytes`.

    `tolerance` is the accepted error of a cut as a share of one shard's bytes.
    """
    total = keys.agg(F.sum("_bytes")).first()[0]
    if not total:
        return []
    cuts = [_Cut(total * i / shards) for i in range(1, shards)]
    accepted = tolerance * total / shards
    for depth, deeper in zip(DEPTHS, DEPTHS[1:]):
        unsettled = [c for c in cuts if c.key is None]
        if not unsettled:
            break
        probed = sorted({c.prefix for c in unsettled})
        interval = F.coalesce(
            *[F.when(_inside(p, depth), F.lit(i)) for i, p in enumerate(probed)]
        )
        counted = (
            keys.withColumn("interval", interval)
            .filter("interval is not null")
            .groupBy("interval", _bits(depth, deeper).alias("probe"))
            .agg(F.sum("_bytes").alias("bytes"), F.count(F.lit(1)).alias("rows"))
            .collect()
        )
        found: dict[int, list] = {}
        for row in counted:
            found.setdefault(probed[row["interval"]], []).append((row["probe"], row["bytes"], row["rows"]))
        for cut in unsettled:
            _refine(cut, sorted(found[cut.prefix]), deeper - depth, deeper, accepted)
    return [c.key for c in cuts]


def _refine(cut: _Cut, bins: list, width: int, deeper: int, accepted: float) -> None:
    """Take the next bits of a cut, or settle it at the nearer end of its interval."""
    below = cut.below
    for probe, size, rows in bins:
        if below + size >= cut.target:
            break
        below += size
    left, right = cut.target - below, below + size - cut.target
    prefix = (cut.prefix << width) | probe
    if min(left, right) <= accepted or rows == 1 or deeper == DEPTHS[-1]:
        cut.key = (prefix if left <= right else prefix + 1) << (DEPTHS[-1] - deeper)
    else:
        cut.prefix, cut.below = prefix, below


def _shard(cuts: list[int]) -> Column:
    high, low = F.col("_high").bitwiseXOR(F.lit(SIGN)), F.col("_low").bitwiseXOR(F.lit(SIGN))
    passed = []
    for cut in cuts:
        if cut >> 128:  # beyond every key
            continue
        top, rest = (cut >> 64) + SIGN, (cut & ((1 << 64) - 1)) + SIGN
        passed.append(((high > F.lit(top)) | ((high == F.lit(top)) & (low >= F.lit(rest)))).cast("int"))
    return reduce(lambda a, b: a + b, passed, F.lit(0))


def histogram_sort(
    rows: DataFrame,
    group: Column,
    row_id: Column,
    size: Column,
    shards: int = 16,
    tolerance: float = 0.01,
) -> DataFrame:
    """`rows` with `shard` (0 to `shards` - 1, bytes near equal) and `slot` (gapless from 0).

    Within a shard rows are dealt to lanes by id, sorted by key in each lane, and numbered
    through: no task handles a whole shard.
    """
    spark = rows.sparkSession
    rows = rows.drop("shard", "slot", *(c for c in rows.columns if c.startswith("_")))
    # Rows that are equal in all else differ in their number, which the written table fixes.
    number = F.monotonically_increasing_id()
    keyed = rows.withColumns(
        {"_high": F.xxhash64(group), "_low": F.xxhash64(row_id, number), "_bytes": size.cast("long")}
    )
    keyed = written(keyed, "histogram-keys")
    keys = keyed.select("_high", "_low", "_bytes")
    cuts = splitters(keys, shards, tolerance)
    per_shard = -(-2 * lanes(spark) // shards)
    place = {
        "shard": _shard(cuts),
        "_lane": F.pmod(F.col("_low"), F.lit(per_shard)).cast("int"),
    }
    # A row per lane: at most shards * lanes of the session, however large the input.
    counts = keys.withColumns(place).groupBy("shard", "_lane").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_lane").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "shard", "_lane", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    order = Window.partitionBy("shard", "_lane").orderBy("_high", "_low", "_bytes")
    return (
        keyed.withColumns(place)
        .join(starts, ["shard", "_lane"])
        .withColumn("slot", F.col("_start") + F.row_number().over(order) - 1)
        .drop("_high", "_low", "_bytes", "_lane", "_start")
    )
