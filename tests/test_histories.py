"""The bucketed store: what is read, what is moved, what is found."""

import random

import pytest
from pyspark.sql import functions as F

from kinrank.sources.histories import HistoryStore

SCHEMA = "user_id bigint, product_id int, rating double"


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(1)
    return [(draw.randint(-50, 200), p, float(1 + p % 5)) for p in range(3000)]


@pytest.fixture
def store(spark, rows):
    kept = HistoryStore.write(spark.createDataFrame(rows, SCHEMA), buckets=8)
    yield kept
    kept.drop()


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_one_user(store, rows):
    for user in (7, -3, 10_000):
        assert sorted(map(tuple, store.of_user(user).collect())) == sorted(r for r in rows if r[0] == user)
    assert store.of_users([]).collect() == []


def test_a_lookup_reads_the_users_buckets_alone(spark, store, rows):
    # Plans only show buckets where rows are read bucket by bucket; the files are left out either way.
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        plan = store.of_user(7)._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert "SelectedBucketsCount: 1 out of 8" in plan
    assert sorted(map(tuple, store.of_users([7, 8, 7]).collect())) == sorted(r for r in rows if r[0] in (7, 8))


def test_targets_join_without_moving_the_ratings(spark, store, rows):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        targets = spark.range(0, 200, 3).withColumnRenamed("id", "user_id")
        found = store.of_targets(targets)
        plan = plan_of(found)
        got = sorted(map(tuple, found.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == sorted(r for r in rows if r[0] in range(0, 200, 3))
    scan_side = plan.split("SortMergeJoin")[1].split("FileScan")[0]
    assert "Exchange" not in scan_side


def test_counts_need_no_exchange(store, rows):
    assert "Exchange" not in plan_of(store.counts())
    counts = {r.user_id: r.n_ratings for r in store.counts().collect()}
    assert sum(counts.values()) == len(rows) and counts.keys() == {r[0] for r in rows}


def test_other_columns_and_types_stay(spark):
    frame = spark.createDataFrame([(1, 2, 3.0, "x"), (None, 2, 3.0, "y")], "user_id int, product_id int, rating double, note string")
    kept = HistoryStore.write(frame, buckets=2)
    assert [tuple(r) for r in kept.of_user(1).collect()] == [(1, 2, 3.0, "x")]
    assert kept.ratings().count() == 2 and kept.ratings().schema == frame.schema
    kept.drop()


def test_a_named_store_is_replaced(spark):
    first = HistoryStore.write(spark.createDataFrame([(1, 1, 1.0)], SCHEMA), "kept_histories", 2)
    second = HistoryStore.write(spark.createDataFrame([(2, 2, 2.0)], SCHEMA), "kept_histories", 2)
    assert second.of_user(1).collect() == [] and len(second.of_user(2).collect()) == 1
    first.drop()
    assert not spark.catalog.tableExists("kept_histories")
