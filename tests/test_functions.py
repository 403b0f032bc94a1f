import datetime as dt

import pytest
from helpers import one, text_of
from pyspark.sql import functions as F

from mobility_lake.functions.display import format_br
from mobility_lake.functions.times import date_from_parts, day_of, iso_utc, parse_event_time
from mobility_lake.functions.values import (
    clean_label,
    congestion_ratio,
    default_label,
    json_pick,
    to_number,
    exact_mean,
    exact_total,
    to_units,
    weather_condition,
)



@pytest.mark.parametrize(
    "text",
    [
        "2024-01-02T06:00:00Z",
        "2024-01-02T06:00:00.000",
        "2024-01-02T06:00:00.000Z",
        "2024-01-02 06:00:00",
        "2024-01-02T06:00:00",
        "2024-01-02T03:00:00-03:00",
        "2024-01-02T03:00:00-0300",
        "2024-01-02T03:00:00-03",
        "2024-01-02T08:00:00.000+02:00",
        " 2024-01-02T06:00:00Z ",
    ],
)
def test_event_time_spellings_name_the_same_instant(spark, text):
    assert text_of(spark, parse_event_time(F.col("t")), t=text) == "2024-01-02 06:00:00.000"


@pytest.mark.parametrize("text", ["junk", "", "12:30", "T12:30:00", "2024-13-02T06:00:00Z", None])
def test_unreadable_event_time_is_null(spark, text):
    assert text_of(spark, parse_event_time(F.col("t")), t=text) is None


def test_extra_patterns_are_tried_in_order(spark):
    patterns = ("dd/MM/yyyy HH:mm", "MM-dd-yyyy")
    read = parse_event_time(F.col("t"), patterns)
    assert text_of(spark, read, t="02/01/2024 06:00") == "2024-01-02 06:00:00.000"
    assert text_of(spark, read, t="01-02-2024") == "2024-01-02 00:00:00.000"
    assert text_of(spark, read, t="neither") is None


def test_iso_text_is_utc_and_cut_to_seconds(spark):
    ts = parse_event_time(F.col("t"))
    assert one(spark, iso_utc(ts), t="2024-01-02T03:00:00.987-03:00") == "2024-01-02T06:00:00Z"
    assert one(spark, day_of(ts), t="2024-01-02T23:00:00-03:00") == dt.date(2024, 1, 3)


def test_date_from_parts(spark):
    def made(y, m, d):
        return one(spark, date_from_parts(F.col("y"), F.col("m"), F.col("d")), y=y, m=m, d=d)

    assert made("2024", "2", "29") == dt.date(2024, 2, 29)
    assert made("2023", "2", "29") is None
    assert made("2024", None, "1") is None
    assert made("x", "1", "1") is None


@pytest.mark.parametrize(
    "text, number",
    [("1.5", 1.5), (" 7 ", 7.0), ("abc", None), ("", None), (None, None), ("NaN", None),
     ("Infinity", None), ("1e3", 1000.0)],
)
def test_to_number(spark, text, number):
    assert one(spark, to_number(F.col("t")), t=text) == number


def test_units_are_exact_and_never_wrap(spark):
    value = "cast(t as double)"
    assert one(spark, to_units(value), t="0.1") == 100_000
    assert one(spark, to_units(value), t="-179.6") == -179_600_000
    assert one(spark, to_units(value), t="1e13") == 1e19
    assert one(spark, to_units(value, 9), t="4e-7") == 400
    ties = {"0.0000005": 1, "0.0000015": 2, "-0.0000025": -3, "49.7107235": 49_710_724,
            "49.7107245": 49_710_725, "0.00000049999999": 0}
    for text, units in ties.items():
        assert one(spark, to_units(value), t=text) == units
    assert one(spark, to_units(value), t="NaN") is None


def test_totals_keep_what_is_below_a_unit(spark):
    for values, expected in (([4e-7] * 1000, 4e-4), ([1e9, 2.5e-10, -1e9], 2.5e-10), ([1e13, 4e-7, 1e13], 2e13),
                             ([None, float("nan")], None), ([0.1] * 10, 1.0)):
        df = spark.createDataFrame([(v,) for v in values], "x double")
        row = df.agg(exact_total("x").alias("total"), exact_mean("x").alias("mean")).first()
        assert row["total"] == expected
        assert row["mean"] == (None if expected is None else expected / len([v for v in values if v is not None]))


@pytest.mark.parametrize(
    "label, cleaned",
    [(" ", None), ("", None), ("Null", None), (" NULL ", None), (None, None), (" Rio ", "Rio"),
     ("nulla", "nulla")],
)
def test_clean_label(spark, label, cleaned):
    assert one(spark, clean_label(F.col("t")), t=label) == cleaned
    assert one(spark, default_label(clean_label(F.col("t")), "x"), t=label) == (cleaned or "x")


@pytest.mark.parametrize(
    "current, free, ratio",
    [("90", "60", 1.5), ("90", "0", None), ("90", None, None), (None, "60", None),
     ("90", "-5", None), ("x", "60", None)],
)
def test_congestion_ratio(spark, current, free, ratio):
    expression = congestion_ratio(F.col("a"), F.col("b"))
    assert one(spark, expression, a=current, b=free) == ratio


def test_json_pick(spark):
    assert one(spark, json_pick(F.col("t"), "$.a.b"), t='{"a": {"b": "x"}}') == "x"
    assert one(spark, json_pick(F.col("t"), "$.a"), t='{"a": null}') is None
    assert one(spark, json_pick(F.col("t"), "$.z"), t='{"a": 1}') is None
    assert one(spark, json_pick(F.col("t"), "$.a", "double"), t='{"a": 12.50}') == 12.5
    assert one(spark, json_pick(F.col("t"), "$.a", "int"), t='{"a": 30.5}') is None
    assert one(spark, json_pick(F.col("t"), "$.a", "int"), t='{"a": "n"}') is None
    assert one(spark, json_pick(F.col("t"), "$.a"), t="{bad") is None


@pytest.mark.parametrize(
    "payload, condition",
    [('{"clima": "sol"}', "sol"), ('{"clima": {"condicao": "sol"}}', "sol"),
     ('{"clima": {"temperatura_c": 3}}', None), ("{}", None), ("{bad", None)],
)
def test_weather_condition_from_text_or_object(spark, payload, condition):
    assert one(spark, weather_condition(F.col("t")), t=payload) == condition


@pytest.mark.parametrize(
    "value, decimals, prefix, shown",
    [("1234.56", 2, "", "1.234,56"), ("1234567.891", 2, "R$ ", "R$ 1.234.567,89"),
     ("1234.5", 0, "", "1.234"), ("0.125", 2, "", "0,12"), (None, 2, "R$ ", "-"),
     ("NaN", 0, "", "-"), ("-1234.5", 1, "", "-1.234,5")],
)
def test_format_br(spark, value, decimals, prefix, shown):
    assert one(spark, format_br(F.col("t").cast("double"), decimals, prefix), t=value) == shown
