import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from kinrank.operators import splits as s

SCHEMA = "user_id bigint, product_id bigint, rating double, ts_s bigint"


@pytest.fixture
def rated(frame):
    draw = random.Random(5)
    rows = [
        (u, p, float(draw.randint(1, 5)), draw.randint(0, 40))
        for u in range(12)
        for p in range(30)
        if draw.random() < 0.6
    ]
    return rows, frame(rows, SCHEMA)


def test_ts_digits(frame):
    rows = [(1, p, 1.0, 100 + p) for p in range(10)]
    found = {r["product_id"]: r["split"] for r in s.split_ts_digit(frame(rows, SCHEMA)).collect()}
    assert found == {
        **dict.fromkeys(range(4), "train"),
        4: "valid",
        5: "test",
        **dict.fromkeys(range(6, 10)),
    }


@pytest.mark.parametrize("split", [s.split_hash, s.split_random])
def test_splits_do_not_depend_on_layout(rated, split):
    _, frame = rated
    again = frame.repartition(5, "product_id").orderBy("rating")
    assert sorted(split(frame).collect()) == sorted(split(again).collect())


def test_random_split_weight(spark):
    pairs = spark.range(10_000).selectExpr("id % 100 AS user_id", "id div 100 AS product_id")
    split = s.split_random(pairs, 0.8, seed=1)
    sizes = {r["split"]: r["n_rows"] for r in s.split_sizes(split).collect()}
    assert 0.78 < sizes["train"] / 10_000 < 0.82


def test_global_index(rated, spark):
    rows, frame = rated
    order = ["ts_s", "user_id", "product_id"]
    indexed = s.with_global_index(frame.repartition(7), order).orderBy("idx").collect()
    assert [r["idx"] for r in indexed] == list(range(len(rows)))
    keys = [(r["ts_s"], r["user_id"], r["product_id"]) for r in indexed]
    assert keys == sorted((t, u, p) for u, p, _, t in rows)


def test_kfold(rated):
    rows, frame = rated
    found = {(r["user_id"], r["product_id"]): r["fold"] for r in s.split_kfold(frame, 5).collect()}
    ordered = sorted((t, u, p) for u, p, _, t in rows)
    assert found == {(u, p): i * 5 // len(rows) + 1 for i, (_, u, p) in enumerate(ordered)}


@pytest.mark.parametrize("start, stop, cap", [(1, 3, None), (2, 4, None), (1, 3, 10), (1, 50, 1)])
def test_ordinals(rated, start, stop, cap):
    rows, frame = rated
    seen, expected = Counter(), set()
    for _, u, p in sorted((t, u, p) for u, p, _, t in rows):
        seen[u] += 1
        if start <= seen[u] <= stop and (cap is None or len(expected) < cap):
            expected.add((u, p))
    split = s.split_ordinals(frame, start, stop, cap=cap)
    assert split.count() == len(rows)
    held = split.where(F.col("split") == "test").collect()
    assert {(r["user_id"], r["product_id"]) for r in held} == expected


def test_few_rows_per_user_reach_the_ordinal_shuffle(rated):
    plan = s.split_ordinals(rated[1], 1, 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_hash_split_takes_any_id(frame):
    big = 2**63 - 1
    rows = [(u, p, 1.0) for u in (-5, 7, big) for p in (-9, 3, big)]
    found = {(r["user_id"], r["product_id"]): r["split"] for r in s.split_hash(frame(rows)).collect()}
    assert found == {
        (u, p): "train" if (u * 7919 + p * 104729) % 1009 % 10 < 8 else "test" for u, p, _ in rows
    }
