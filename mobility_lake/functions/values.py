"""Tolerant value expressions: bad input becomes NULL, never an error."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Doubles are summed as whole units of 10**-SCALE: exact, independent of task order (a replay
# or a merge of partials gives the same bits). A unit is cut into three limbs, each summed in a
# long that holds the limbs of 2**41 rows; what is left of a value below a unit is summed in units of
# 10**-FINE, what does not fit into a long as a decimal, and what does not fit into that as a double.
# Nothing overflows and nothing is left out. Values of SCALE decimals are summed as decimals.
SCALE = 6
FINE = 15
_LIMB = 22
_LONG = 2**62
_DECIMAL = "1e28D"
# Suffixes of the sums that make up one exact sum.
PARTS = ("low", "mid", "high", "fine", "large", "huge")


def json_pick(text: Column, path: str, dtype: str | None = None) -> Column:
    """One JSON path as text, or cast to `dtype` with NULL for unreadable values.

    For more than three fields of the same text use one `from_json` instead.
    """
    picked = F.get_json_object(text, path)
    return picked.try_cast(dtype) if dtype else picked


def to_number(value: Column) -> Column:
    """Double, or NULL when the text is not a finite number."""
    number = value.try_cast("double")
    # NaN compares greater than every number, so it fails the test as well.
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def _double(value: str) -> str:
    return f"cast({value} as double)"


def _bind(value: str, name: str, body: str) -> str:
    """`body` with a name for a value that it uses more than once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def units_sql(value: str, scale: int = SCALE) -> str:
    """SQL: double to whole units, as a double; NULL when not finite.

    Ties go away from zero, as a warehouse's fixed-point columns round them (`rint`
    alone would take the even neighbour). The expressions here are SQL text, as a tree of column
    objects takes longer to build than a small table to sum.
    """
    number = _double(value)
    scaled = f"({number} * 1e{scale}D)"
    away = f"rint({scaled}) + if(({scaled} - rint({scaled})) * signum({scaled}) = 0.5D, signum({scaled}), 0D)"
    return f"if(abs({number}) < double('Infinity'), {away}, null)"


def to_units(value: str, scale: int = SCALE) -> Column:
    return F.expr(units_sql(value, scale))


def sums_sql(value: str, scale: int = SCALE, units: str | None = None) -> dict[str, str]:
    """SQL aggregates: the sums that make up an exact sum, by part. `units` names a column that has the units already."""
    units = units or units_sql(value, scale)
    whole = f"cast(if(abs({units}) < {_LONG}D, {units}, null) as bigint)"
    mask = (1 << _LIMB) - 1
    rest = f"({_double(value)} - {units} / 1e{scale}D)"
    return {
        "low": f"sum({whole} & {mask}L)",
        "mid": f"sum(shiftright({whole}, {_LIMB}) & {mask}L)",
        "high": f"sum(shiftright({whole}, {2 * _LIMB}))",
        "fine": f"sum(cast(rint(if(abs({units}) < {_LONG}D, {rest}, null) * 1e{FINE}D) as bigint))",
        "large": f"sum(cast(if(abs({units}) between {_LONG}D and {_DECIMAL}, {units}, null) as decimal(38,0)))",
        "huge": f"sum(if(abs({units}) > {_DECIMAL}, {_double(value)}, null))",
    }


def total_sql(parts: Mapping[str, str], scale: int = SCALE, bound: bool = False) -> str:
    """SQL: the sum that the parts make up; NULL when all of them are.

    As one expression it is compiled with the aggregate. `bound` names what is used more than once, which
    keeps the text of long parts short, and is interpreted: for results of few rows.
    """
    p = {name: f"z.{name}" for name in parts} if bound else {name: f"({sql})" for name, sql in parts.items()}
    limbs = {"high": 1 << 2 * _LIMB, "mid": 1 << _LIMB, "low": 1}
    whole = " + ".join(f"cast({p[name]} as decimal(38,0)) * {size}" for name, size in limbs.items())
    units = f"cast(coalesce({whole}, 0) + coalesce({p['large']}, 0) as decimal(38,0))"
    u = "u" if bound else units
    finer = f"cast({u} * {10 ** (FINE - scale)} + {p['fine']} as decimal(38,0))"
    fine = _bind(finer, "v", _as_double("v", FINE)) if bound else _as_double(finer, FINE)
    total = f"if({p['fine']} != 0 and abs({u}) < 1{'0' * 22}, {fine}, {_as_double(u, scale)})"
    some = f"coalesce(cast({p['low']} as double), cast({p['large']} as double), {p['huge']})"
    total = f"if({some} is null, null, {_bind(units, 'u', total) if bound else total} + coalesce({p['huge']}, 0D))"
    if not bound:
        return total
    held = ", ".join(f"'{name}', {sql}" for name, sql in parts.items())
    return _bind(f"named_struct({held})", "z", total)


def _as_double(units: str, scale: int) -> str:
    """A whole number of units as a double. A double holds them up to 2**53; beyond that whole ones and the rest
    are rounded apart."""
    one = 10**scale
    whole, rest = f"cast({units} div cast({one} as decimal(38,0)) as double)", f"cast({units} % cast({one} as decimal(38,0)) as double)"
    is_split = f"abs({units}) between {1 << 53} and {9 * 10**18 * one}"
    return f"if({is_split}, {whole} + {rest} / {one}D, cast({units} as double) / {one}D)"


def count_sql(value: str) -> str:
    """SQL aggregate: how many values entered the sum."""
    return f"count(if(abs({_double(value)}) < double('Infinity'), 1, null))"


def exact_total(value: str, scale: int = SCALE, units: str | None = None) -> Column:
    """Aggregate: sum of a double column."""
    return F.expr(total_sql(sums_sql(value, scale, units), scale, bound=units is None))


def exact_mean(value: str, scale: int = SCALE, units: str | None = None) -> Column:
    """Aggregate: mean of a double column; NULL for a group without values."""
    return F.expr(f"{total_sql(sums_sql(value, scale, units), scale, bound=units is None)} / nullif({count_sql(value)}, 0)")


def rounded_total(value: str) -> Column:
    """Aggregate: sum of a double column of which each value counts to `SCALE` decimals."""
    return F.expr(total_sql(sums_sql(value) | {"fine": "cast(null as bigint)"}, bound=True))


def rounded_mean(value: str) -> Column:
    """Aggregate: mean of a double column of which each value, such as a mean itself, counts to `SCALE` decimals."""
    return F.expr(f"{total_sql(sums_sql(value) | {'fine': 'cast(null as bigint)'}, bound=True)} / nullif({count_sql(value)}, 0)")


def clean_label(label: Column) -> Column:
    """Trimmed label; blank and any-case "null" count as missing."""
    trimmed = F.trim(label)
    return F.when((trimmed != "") & (F.upper(trimmed) != "NULL"), trimmed)


def default_label(label: Column, value: str) -> Column:
    """Label with a spelled-out default for NULL."""
    return F.coalesce(label, F.lit(value))


def congestion_ratio(current_time: Column, free_flow_time: Column) -> Column:
    """Travel time over free-flow travel time; NULL unless both are numbers and free flow > 0."""
    current, free = to_number(current_time), to_number(free_flow_time)
    return F.when(free > 0, current / free)


def cell_of(degrees: Column) -> Column:
    """Number of a grid line of 0.01 degrees, from south or west."""
    return F.floor(degrees * 100).cast("bigint")


def grid_cell(lat: Column, lon: Column) -> Column:
    """Name of the grid cell of a place; NULL unless both coordinates are there."""
    return F.concat(cell_of(lat).cast("string"), F.lit(":"), cell_of(lon).cast("string"))


def is_json_object(text: Column) -> Column:
    return F.ltrim(text).startswith("{")


def weather_condition(payload: Column, field: str = "clima", inner: str = "condicao") -> Column:
    """Condition from a payload whose weather field is either text or an object."""
    return condition_of(F.get_json_object(payload, f"$.{field}"), inner)


def condition_of(weather: Column, inner: str = "condicao") -> Column:
    """Condition from the weather field itself: its text, or the inner field of an object."""
    return F.when(is_json_object(weather), F.get_json_object(weather, f"$.{inner}")).otherwise(
        weather
    )
