"""Rollups as data: keys plus measures, one function for batch and for micro-batches.

Plan notes. Plain measures aggregate map-side, so a hot hour or city costs one partial
row per task. Exact distinct counts are Spark's own two-phase plan: the first shuffle is
on (keys, id), which spreads a hot group over all tasks, the second carries counts only.
Sums run over whole units in limbs (see `functions.values`), so any split of the input -
tasks, micro-batches, partials - gives the same bits.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mobility_lake.functions.values import (
    PARTS,
    SCALE,
    count_sql,
    exact_mean,
    exact_total,
    sums_sql,
    total_sql,
    units_sql,
)
from mobility_lake.operators.conform import ensure_columns
from mobility_lake.operators.quality import require_all

_RESULT_TYPE = {
    "distinct": "bigint",
    "approx": "bigint",
    "sketch": "binary",
    "mean": "double",
    "total": "double",
    "min": "double",
    "max": "double",
    "count_if": "bigint",
    "latest": "timestamp",
}


@dataclass(frozen=True)
class Measure:
    """One output column of a rollup.

    `scale` is the number of decimals in whose units totals and means are summed first. `dtype` is the type of
    a missing optional column, for kinds that return the column's own type.
    """

    name: str
    kind: str
    column: str | None = None
    predicate: str | None = None
    optional: bool = False
    scale: int = SCALE
    dtype: str | None = None

    def _is_absent(self, present: set[str]) -> bool:
        if self.column is None or self.column in present:
            return False
        if not self.optional:
            raise ValueError(f"measure {self.name!r} needs column {self.column!r}")
        return True

    @property
    def units(self) -> str | None:
        """The working column of its units, shared by all measures that sum the same column."""
        return f"_units{self.scale}_{self.column}" if self.kind in ("mean", "total") else None

    def full(self, present: set[str]) -> Column:
        """The finished aggregate; a typed NULL when an optional column is missing."""
        if self._is_absent(present):
            dtype = self.dtype or _RESULT_TYPE[self.kind]
            return F.max(F.lit(None).cast(dtype)).alias(self.name)
        return self._aggregate().alias(self.name)

    def _aggregate(self) -> Column:
        if self.kind == "rows":
            return F.count("*")
        if self.kind == "count_if":
            return F.count_if(F.expr(self.predicate))
        if self.kind in ("mean", "total"):
            finish = exact_mean if self.kind == "mean" else exact_total
            return finish(f"`{self.column}`", self.scale, f"`{self.units}`")
        column = F.col(self.column)
        if self.kind in ("approx", "sketch"):  # the same sketch as in partial rows, so that both give one number
            held = F.hll_sketch_agg(column.cast("string"))
            return held if self.kind == "sketch" else F.hll_sketch_estimate(held)
        return {
            "distinct": F.count_distinct,
            "min": F.min,
            "max": F.max,
            "latest": F.max,
        }[self.kind](column)

    def partial(self, present: set[str]) -> list[Column]:
        """Mergeable state columns; NULL states when an optional column is missing."""
        if self.kind in ("rows", "count_if"):
            return [self._aggregate().alias(self.name)]
        absent = self._is_absent(present)
        if self.kind in ("min", "max", "latest"):
            return [self.full(present)]
        # An absent column is a column of NULLs, whose states merge like any other.
        column = F.lit(None).cast("double") if absent else F.col(self.column)
        seen = F.max(F.lit(not absent)).alias(f"{self.name}__seen")
        if self.kind == "distinct":  # the values themselves are kept beside: see `distinct_ids`
            return [seen]
        if self.kind in ("approx", "sketch"):
            return [F.hll_sketch_agg(column.cast("string")).alias(f"{self.name}__hll"), seen]
        value = "cast(null as double)" if absent else f"`{self.column}`"
        sums = sums_sql(value, self.scale, None if absent else f"`{self.units}`") | {"n": count_sql(value)}
        return [F.expr(sql).alias(f"{self.name}__{suffix}") for suffix, sql in sums.items()]

    def merged(self) -> Column:
        """The finished value over partial rows."""
        if self.kind in ("rows", "count_if"):
            merged = F.sum(self.name)
        elif self.kind == "min":
            merged = F.min(self.name)
        elif self.kind in ("max", "latest"):
            merged = F.max(self.name)
        elif self.kind == "distinct":
            merged = F.when(F.max(f"{self.name}__seen"), F.coalesce(F.sum(f"{self.name}__count"), F.lit(0)))
        elif self.kind in ("approx", "sketch"):
            held = F.hll_union_agg(f"{self.name}__hll")
            value = held if self.kind == "sketch" else F.hll_sketch_estimate(held)
            merged = F.when(F.max(f"{self.name}__seen"), value)
        else:
            merged = total_sql({part: f"sum(`{self.name}__{part}`)" for part in PARTS}, self.scale)
            if self.kind == "mean":
                merged += f" / nullif(sum(`{self.name}__n`), 0)"
            merged = F.expr(merged)
        return merged.alias(self.name)

    def combined(self) -> list[Column]:
        """The state of several partial rows as one: what compaction keeps."""
        if self.kind in ("rows", "count_if"):
            return [F.sum(self.name).alias(self.name)]
        if self.kind == "min":
            return [F.min(self.name).alias(self.name)]
        if self.kind in ("max", "latest"):
            return [F.max(self.name).alias(self.name)]
        if self.kind in ("distinct", "approx", "sketch"):
            seen = F.max(f"{self.name}__seen").alias(f"{self.name}__seen")
            union = [F.hll_union_agg(f"{self.name}__hll").alias(f"{self.name}__hll")] if self.kind != "distinct" else []
            return [*union, seen]
        suffixes = (*PARTS, "n")
        return [F.sum(f"{self.name}__{x}").alias(f"{self.name}__{x}") for x in suffixes]


def rows(name: str) -> Measure:
    """Row count."""
    return Measure(name, "rows")


def distinct(name: str, column: str, optional: bool = False) -> Measure:
    """Exact distinct count, NULL ignored."""
    return Measure(name, "distinct", column, optional=optional)


def approx(name: str, column: str, optional: bool = False) -> Measure:
    """Approximate distinct count, NULL ignored."""
    return Measure(name, "approx", column, optional=optional)


def sketch(name: str, column: str, optional: bool = False) -> Measure:
    """The sketch that `approx` estimates from, as a column: sketches of hours unite to that of a day."""
    return Measure(name, "sketch", column, optional=optional)


def united_count(name: str) -> Column:
    """Aggregate: how many distinct values the sketches of a column have seen together, estimated; 0 without any."""
    return F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(name)), F.lit(0).cast("bigint"))


def mean(name: str, column: str, optional: bool = False, scale: int = SCALE) -> Measure:
    return Measure(name, "mean", column, optional=optional, scale=scale)


def total(name: str, column: str, optional: bool = False, scale: int = SCALE) -> Measure:
    return Measure(name, "total", column, optional=optional, scale=scale)


def low(name: str, column: str, optional: bool = False, dtype: str | None = None) -> Measure:
    return Measure(name, "min", column, optional=optional, dtype=dtype)


def high(name: str, column: str, optional: bool = False, dtype: str | None = None) -> Measure:
    return Measure(name, "max", column, optional=optional, dtype=dtype)


def count_if(name: str, predicate: str) -> Measure:
    """Rows for which the SQL predicate holds; 0 when none."""
    return Measure(name, "count_if", predicate=predicate)


def latest(name: str, column: str, optional: bool = False) -> Measure:
    """Latest timestamp."""
    return Measure(name, "latest", column, optional=optional)


@dataclass(frozen=True)
class RollupSpec:
    """Keys, measures, required columns, and `{column: (type, default)}` for absent ones."""

    name: str
    keys: tuple[str, ...]
    measures: tuple[Measure, ...]
    require: tuple[str, ...] = ()
    defaults: dict[str, tuple[str, object]] = field(default_factory=dict)

    def with_keys(self, *keys: str, name: str | None = None) -> RollupSpec:
        return replace(self, keys=keys, name=name or self.name)

    def exact(self) -> RollupSpec:
        """The same rollup with exact instead of approximate distinct counts."""
        swapped = [replace(m, kind="distinct") if m.kind == "approx" else m for m in self.measures]
        return replace(self, measures=tuple(swapped))

    @property
    def columns(self) -> list[str]:
        return [*self.keys, *[measure.name for measure in self.measures]]


def prepare(df: DataFrame, spec: RollupSpec) -> DataFrame:
    """Back-fill and filter as the spec demands."""
    return require_all(ensure_columns(df, spec.defaults), spec.require)


def with_units(df: DataFrame, spec: RollupSpec) -> DataFrame:
    """`df` with the units of what is summed, computed once per value and ahead of the aggregate."""
    present = set(df.columns)
    wanted = {m.units: units_sql(f"`{m.column}`", m.scale) for m in spec.measures if m.units and m.column in present}
    return df.withColumns({name: F.expr(sql) for name, sql in wanted.items()}) if wanted else df


def rollup(df: DataFrame, spec: RollupSpec) -> DataFrame:
    """Aggregate `df` as the spec says."""
    ready = with_units(prepare(df, spec), spec)
    present = set(ready.columns)
    return ready.groupBy(*spec.keys).agg(*[m.full(present) for m in spec.measures])


def distinct_ids(df: DataFrame, spec: RollupSpec) -> DataFrame | None:
    """The mergeable state of exact distinct counts: a row per key, measure and value, each once.

    None if the spec has no such measure. Sets of rows merge by union, however a group's values are
    spread, and a group with many values is many rows and never one. The shuffle is on
    (key, measure, value), as that of a plain distinct count.
    """
    ready = prepare(df, spec)
    wanted = [m for m in spec.measures if m.kind == "distinct" and m.column in ready.columns]
    if not any(m.kind == "distinct" for m in spec.measures):
        return None
    listed = F.array(*[F.struct(F.lit(m.name).alias("measure"), F.col(m.column).cast("string").alias("value")) for m in wanted])
    if not wanted:
        listed = F.expr("cast(array() as array<struct<measure: string, value: string>>)")
    rows = ready.select(*spec.keys, F.explode(listed).alias("_id"))
    return rows.select(*spec.keys, "_id.measure", "_id.value").filter("value is not null").distinct()


def _counts(ids: DataFrame, spec: RollupSpec) -> DataFrame:
    """Values per key as columns `<measure>__count`; the ids of several partials may repeat."""
    names = [m.name for m in spec.measures if m.kind == "distinct"]
    each = [F.count_if(F.col("measure") == name).alias(f"{name}__count") for name in names]
    return ids.distinct().groupBy(*spec.keys).agg(*each)


def rollup_partial(df: DataFrame, spec: RollupSpec) -> DataFrame:
    """Mergeable state per key but for the values of exact distinct counts, which `distinct_ids` has."""
    ready = with_units(prepare(df, spec), spec)
    present = set(ready.columns)
    states = [state for measure in spec.measures for state in measure.partial(present)]
    return ready.groupBy(*spec.keys).agg(*states)


def rollup_combine(partials: DataFrame, spec: RollupSpec) -> DataFrame:
    """Partial rows of one key as one partial row."""
    states = [state for measure in spec.measures for state in measure.combined()]
    return partials.groupBy(*spec.keys).agg(*states)


def rollup_merge(partials: DataFrame, spec: RollupSpec, ids: DataFrame | None = None) -> DataFrame:
    """Finish partial rows, with the rows of `distinct_ids` if the spec counts distinct values: same columns as `rollup`."""
    if any(m.kind == "distinct" for m in spec.measures):
        if ids is None:
            raise ValueError("exact distinct counts need their values")
        partials = partials.unionByName(_counts(ids, spec), allowMissingColumns=True)
    return partials.groupBy(*spec.keys).agg(*[m.merged() for m in spec.measures])


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct non-NULL combinations of the columns."""
    return require_all(df, columns).select(*columns).distinct()
