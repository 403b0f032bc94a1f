"""Every registered query against its SQL twin, and the one without against brute force."""

import oracle
import pytest

import __spark_entry__ as entry
from entry_queries.registry import ORACLE, QUERIES


@pytest.fixture(scope="module")
def connection(sf):
    return oracle.connect(sf)


def test_every_sql_twin_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLE) == {"agg_distinct_approx"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf, connection, name):
    only_spark, only_sql, wrong_types = oracle.compare(QUERIES[name](spark, sf), connection, ORACLE[name])
    assert not wrong_types
    assert not only_spark and not only_sql, (only_spark[:3], only_sql[:3])


def test_approximate_counts_are_close(spark, sf, connection):
    wanted = dict(
        connection.sql("select event_type, count(distinct user_id) from events group by 1").fetchall()
    )
    found = QUERIES["agg_distinct_approx"](spark, sf).collect()
    assert {r["event_type"] for r in found} == set(wanted)
    for row in found:
        assert abs(row["users"] - wanted[row["event_type"]]) <= 0.15 * wanted[row["event_type"]] + 1


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
