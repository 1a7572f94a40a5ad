"""Rows at places of an order, held to sorting."""

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from kinrank.operators import selection as sel
from kinrank.operators import splits


@pytest.fixture(params=[(4096, 2048), (256, 1)])
def sizes(request, monkeypatch):
    monkeypatch.setattr(sel, "BUCKETS", request.param[0])
    monkeypatch.setattr(sel, "FEW", request.param[1])


def nulls_first(row):
    return tuple((v is not None, v or 0) for v in row)


def sample(kind, draw, n=700):
    if kind == "spread":
        return [(draw.randint(-(2**62), 2**62), draw.randint(0, 5)) for _ in range(n)]
    if kind == "hot":
        return [(draw.choice([7, 7, 7, 7, 8, -1]), draw.randint(-100, 10**9)) for _ in range(n)]
    if kind == "nulls":
        return [(draw.choice([None, None, 1, 2]), draw.choice([None, *range(50)])) for _ in range(n)]
    return [(3, 3)] * n


@pytest.mark.parametrize("kind", ["spread", "hot", "nulls", "equal"])
def test_rows_at_places(spark, kind, sizes):
    rows = sample(kind, random.Random(4))
    frame = spark.createDataFrame(rows, "a bigint, b int")
    places = [0, 1, 99, 350, 350, 351, 698, 699]
    want = sorted(rows, key=nulls_first)
    assert sel.rows_at(frame, ["a", "b"], places, 700) == [want[p] for p in places]


def test_places_outside_are_refused(spark):
    frame = spark.range(5)
    with pytest.raises(IndexError):
        sel.rows_at(frame, ["id"], [5], 5)
    assert sel.rows_at(frame, ["id"], [], 5) == []


@pytest.mark.parametrize("kind", ["spread", "hot", "nulls"])
def test_reaches_is_the_order(spark, kind):
    rows = sample(kind, random.Random(5), 60)
    frame = spark.createDataFrame(rows, "a bigint, b int")
    for bound in rows[:6]:
        marked = frame.select("a", "b", sel.at_or_behind(frame, ["a", "b"], bound).alias("behind")).collect()
        assert all(r.behind == (nulls_first((r.a, r.b)) >= nulls_first(bound)) for r in marked)


@pytest.mark.parametrize(("n", "k"), [(0, 3), (1, 5), (2, 5), (10, 3), (701, 5), (64, 1)])
def test_folds_are_equal_parts_of_the_order(spark, n, k, sizes):
    draw = random.Random(n)
    rows = [(draw.randint(0, 40), draw.randint(0, 3), i) for i in range(n)]
    draw.shuffle(rows)
    got = splits.split_kfold(spark.createDataFrame(rows, "ts_s bigint, user_id bigint, product_id int"), k)
    assert got.columns == ["ts_s", "user_id", "product_id", "fold"] and dict(got.dtypes)["fold"] == "int"
    want = {row: i * k // n + 1 for i, row in enumerate(sorted(rows))}
    assert {tuple(r)[:3]: r.fold for r in got.collect()} == want


def test_dates_and_timestamps(spark):
    rows = [(date(1969 + i % 7, 1, 1 + i % 28), datetime(2020, 1, 1, i % 24, i % 60), bool(i % 2)) for i in range(200)]
    frame = spark.createDataFrame(rows, "d date, t timestamp, b boolean")
    got = sel.with_fold(frame, ["d", "t", "b"], 4).groupBy("fold").agg(F.max("d").alias("high"), F.min("d").alias("low")).collect()
    by_fold = {r.fold: r for r in got}
    assert all(by_fold[f].high <= by_fold[f + 1].low for f in (1, 2, 3))


def test_nothing_is_sorted_or_moved(spark):
    frame = spark.range(50_000).select((F.col("id") * 7919 % 50_000).alias("ts_s"), "id", (F.col("id") % 9).alias("b"))
    folds = splits.split_kfold(frame, 5, ["ts_s", "id", "b"])
    plan = folds._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
    assert sorted((r.fold, r["count"]) for r in folds.groupBy("fold").count().collect()) == [(f, 10_000) for f in range(1, 6)]


def test_other_orders_are_numbered(spark):
    frame = spark.createDataFrame([(f"u{i:03}", i) for i in range(30)], "name string, x int")
    got = {r.name: r.fold for r in splits.split_kfold(frame, 3, ["name"]).collect()}
    assert got == {f"u{i:03}": i // 10 + 1 for i in range(30)}


@pytest.mark.parametrize("cap", [0, 1, 7, 39, 40, 1000])
def test_cap_of_held_rows(spark, cap, sizes):
    draw = random.Random(6)
    rows = [(u, p, 1.0, draw.randint(0, 10**6)) for u in range(20) for p in range(5)]
    frame = spark.createDataFrame(rows, "user_id bigint, product_id bigint, rating double, ts_s bigint")
    held = []
    for u in range(20):
        held += sorted((r for r in rows if r[0] == u), key=lambda r: (r[3], r[0], r[1]))[:2]
    first = {(r[0], r[1]) for r in sorted(held, key=lambda r: (r[3], r[0], r[1]))[:cap]}
    got = splits.split_ordinals(frame, 1, 2, cap=cap).where("split = 'test'").collect()
    assert {(r.user_id, r.product_id) for r in got} == first
