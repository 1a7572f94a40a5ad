"""Every registered query against its SQL in a second engine."""

import pytest
from compare import duck, rows_of_spark, rows_of_sql, types_of_spark, types_of_sql

import __spark_entry__ as registered
from kinrank.plans.registry import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, connection, name):
    found = QUERIES[name](spark, FOLDER)
    assert types_of_spark(found) == types_of_sql(connection, ORACLES[name])
    assert rows_of_spark(found) == rows_of_sql(connection, ORACLES[name])


def test_only_factor_scores_have_no_sql():
    assert all(name.startswith("als_") for name in QUERIES.keys() - ORACLES.keys())
    assert ORACLES.keys() <= QUERIES.keys()
    assert QUERIES.items() <= registered.queries().items()
    assert ORACLES.items() <= registered.oracle_sql().items()


def test_entry_has_rows_and_names(spark):
    rows = registered.entry(spark).collect()
    assert rows and all(row["name"] for row in rows)
    assert max(row["pos"] for row in rows) <= 10


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
def test_timestamps_do_not_depend_on_the_session_zone(spark, connection, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        found = rows_of_spark(QUERIES["parse_ratings_ts_bucket"](spark, FOLDER))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert found == rows_of_sql(connection, ORACLES["parse_ratings_ts_bucket"])


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("als_")))
def test_plan_pairs_nothing_without_a_key(spark, folder, name):
    plan = QUERIES[name](spark, folder)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
