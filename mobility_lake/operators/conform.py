"""Bring a table to its contract: names, types, defaults, event time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mobility_lake.functions.times import date_from_parts, day_of, parse_event_time
from mobility_lake.functions.values import is_json_object

JSON_FIELD = "_json_"
WEATHER_OBJECT = "_weather_object"

CALENDAR = {
    "event_date": F.to_date,
    "event_hour": F.hour,
    "year": F.year,
    "month": F.month,
    "day": F.dayofmonth,
    "hour": F.hour,
}


def parse_payload(
    df: DataFrame, schema: T.StructType, value: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """Parse JSON text into columns of `schema`, next to the `keep` columns.

    A malformed record gives NULL in every field; a field of the wrong type is NULL
    and leaves the others alone. The row itself is always kept.
    """
    parsed = parsed_once(F.col(value).cast("string"), schema).alias("_payload")
    return df.select(*keep, parsed).select(*keep, "_payload.*")


def parsed_once(text: Column, schema: T.StructType) -> Column:
    """JSON text as a struct that is not parsed again by the filters above it.

    A filter on a plain `from_json` column is pushed below the projection and parses the
    text once more per field it looks at; it cannot move below a generator.
    """
    return F.explode(F.array(F.from_json(text, schema)))


def pick_fields(df: DataFrame, fields: Sequence[str], value: str = "value") -> DataFrame:
    """Add JSON fields of `value` as text columns named `JSON_FIELD + name`, in one parse."""
    names = [JSON_FIELD + name for name in fields]
    return df.select("*", F.json_tuple(F.col(value), *fields).alias(*names))


def first_existing(df: DataFrame, names: Sequence[str]) -> str | None:
    """First of `names` that is a column of `df`."""
    present = set(df.columns)
    return next((name for name in names if name in present), None)


def resolve_alias(
    df: DataFrame,
    columns: Sequence[str] = (),
    json_fields: Sequence[str] = (),
    dtype: str = "string",
    default: object = None,
    payload: str = "value",
) -> Column:
    """First non-NULL among the columns that exist, then JSON fields, then `default`.

    JSON fields come from `pick_fields` columns where present, else from `payload`,
    which is a parsed struct or JSON text.
    """
    present = set(df.columns)
    candidates = [F.col(name) for name in columns if name in present]
    for name in json_fields:
        if JSON_FIELD + name in present:
            candidates.append(F.col(JSON_FIELD + name))
        elif payload in present and isinstance(df.schema[payload].dataType, T.StructType):
            candidates.append(F.col(payload)[name])
        elif payload in present:
            candidates.append(F.get_json_object(F.col(payload), f"$.{name}"))
    return F.coalesce(*[c.try_cast(dtype) for c in candidates], F.lit(default).cast(dtype))


def resolve_event_time(
    df: DataFrame, candidates: Sequence[str], now_if_missing: bool = False
) -> Column:
    """First readable event time among the candidate columns that exist, in order.

    Text is parsed, timestamps are taken as they are. `now_if_missing` is off by default
    because a replay would change the result.
    """
    kinds = {field.name: field.dataType for field in df.schema}
    times = []
    for name in candidates:
        if name not in kinds:
            continue
        is_text = isinstance(kinds[name], T.StringType)
        times.append(parse_event_time(F.col(name)) if is_text else F.col(name).cast("timestamp"))
    if now_if_missing:
        times.append(F.current_timestamp())
    return F.coalesce(*times) if times else F.lit(None).cast("timestamp")


def with_event_date(df: DataFrame, event_ts: str = "event_ts") -> DataFrame:
    """Add `event_date`."""
    return df.withColumn("event_date", day_of(F.col(event_ts)))


def with_event_calendar(
    df: DataFrame,
    parts: Sequence[str] = ("event_date", "event_hour"),
    event_ts: str = "event_ts",
) -> DataFrame:
    """Add calendar parts of the event time; see `CALENDAR` for the names."""
    return df.withColumns({part: CALENDAR[part](F.col(event_ts)) for part in parts})


def event_date_from_parts(df: DataFrame) -> DataFrame:
    """Add `event_date, event_hour` from year/month/day/hour, or normalise existing ones."""
    present = set(df.columns)
    if {"year", "month", "day", "hour"} <= present:
        return df.withColumns(
            {
                "event_date": date_from_parts(F.col("year"), F.col("month"), F.col("day")),
                "event_hour": F.col("hour").cast("int"),
            }
        )
    if {"event_date", "event_hour"} <= present:
        return df.withColumns(
            {
                "event_date": F.col("event_date").cast("date"),
                "event_hour": F.col("event_hour").cast("int"),
            }
        )
    raise ValueError("need year, month, day, hour or event_date, event_hour")


def ensure_columns(df: DataFrame, wanted: Mapping[str, tuple[str, object]]) -> DataFrame:
    """Add each missing column as a typed default: `{name: (type, default)}`."""
    present = set(df.columns)
    missing = {
        name: F.lit(default).cast(dtype)
        for name, (dtype, default) in wanted.items()
        if name not in present
    }
    return df.withColumns(missing) if missing else df


def rename_if_absent(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename old to new only where old exists and new does not; the first claim wins."""
    present = set(df.columns)
    renames = {}
    for old, new in names.items():
        if old in present and new not in present:
            renames[old] = new
            present.add(new)
    return df.withColumnsRenamed(renames)


def pick_spellings(df: DataFrame, names: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rename the first existing spelling of each column to its canonical name."""
    renames = {}
    for name, spellings in names.items():
        found = first_existing(df, spellings)
        if found and found != name:
            renames[found] = name
    return df.withColumnsRenamed(renames)


def with_weather_object(df: DataFrame, weather: str, schema: T.StructType) -> DataFrame:
    """Add `WEATHER_OBJECT`: the weather field as a struct where its text is an object."""
    text = F.col(weather)
    parsed = parsed_once(F.when(is_json_object(text), text), schema)
    return df.select("*", parsed.alias(WEATHER_OBJECT))


def weather_word(weather: str) -> Column:
    """Condition after `with_weather_object`: the text itself, or the field of the object."""
    text = F.col(weather)
    return F.when(is_json_object(text), F.col(WEATHER_OBJECT)["condicao"]).otherwise(text)


def flatten_weather(df: DataFrame, struct: str = "clima") -> DataFrame:
    """Replace the weather struct by flat `weather_*` columns."""
    names = {
        "condicao": "weather_condition",
        "temperatura_c": "weather_temperature_c",
        "chuva_mm_h": "weather_rain_mm_h",
        "visibilidade_m": "weather_visibility_m",
    }
    kept = [name for name in df.columns if name != struct]
    return df.select(*kept, *[F.col(struct)[old].alias(new) for old, new in names.items()])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of `schema`, in order and type; a missing one is an error."""
    return df.select(*[F.col(field.name).cast(field.dataType) for field in schema])


def zero_fill(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL measures become 0 in the given columns."""
    return df.withColumns({name: F.coalesce(F.col(name), F.lit(0)) for name in columns})


def stamp(df: DataFrame, name: str) -> DataFrame:
    """Add the processing time."""
    return df.withColumn(name, F.current_timestamp())
