"""Neighbours' ratings of held-out products, against a plain join."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinrank.operators import folds as fo
from kinrank.operators import lookups

RATED = "user_id bigint, product_id bigint, rating double, fold int"
NEAR = "fold int, user_id bigint, neighbour_id bigint, sim double"


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(3)
    return [
        (u * 7 - 60, p * 10**9, draw.randint(1, 5) / 2, draw.randint(1, 3))
        for u in range(60)
        for p in range(20)
        if draw.random() < 0.5
    ]


@pytest.fixture(scope="module")
def near(rows):
    draw = random.Random(4)
    users = sorted({r[0] for r in rows})
    found = [(f, u, v, draw.uniform(-1, 1)) for f in (1, 2, 3) for u in users for v in draw.sample(users, 6) if v != u]
    # one whom everybody is near to, one who rated nothing, and one who asks for nothing
    return found + [(2, u, 10**12, 0.5) for u in users] + [(1, 10**13, users[0], 0.5)]


def plain(rows, near):
    rated = {(u, p): (r, f) for u, p, r, f in rows}
    sums = {key: [r, f, 0, 0.0, 0.0] for key, (r, f) in rated.items()}
    for fold, u, v, sim in near:
        for (who, p), (_, f) in rated.items():
            if who == u and f == fold and (v, p) in rated and rated[v, p][1] != fold:
                sums[u, p][2] += 1
                sums[u, p][3] += sim * rated[v, p][0]
                sums[u, p][4] += sim
    return {key: (r, f, n, pytest.approx(num), pytest.approx(den)) for key, (r, f, n, num, den) in sums.items()}


@pytest.mark.parametrize("bucket", [40, 10**6])
@pytest.mark.parametrize("table", [0, 1 << 20])
def test_sums_are_those_of_a_join(spark, rows, near, monkeypatch, bucket, table):
    monkeypatch.setattr(lookups, "BUCKET_RATINGS", bucket)
    ratings, neighbours = spark.createDataFrame(rows, RATED), spark.createDataFrame(near, NEAR)
    got = {(r.user_id, r.product_id): (r.rating, r.fold, r.n, r.num, r.den) for r in lookups.held_out_sums(neighbours, ratings).collect()}
    assert got == plain(rows, near)


@pytest.mark.parametrize("share", [0, 16])
def test_places(monkeypatch, share):
    monkeypatch.setattr(lookups, "TABLE_SHARE", share)
    monkeypatch.setattr(lookups, "TABLE_LEAST", 0)
    places = lookups.Places(np.array([5, 5, -2, 9]), np.array([30, 10, 10, 20]))
    assert (places.table is None) == (share == 0)
    found = places.find(np.array([5, 9, 7, -2, 100]), np.array([3, 1, 1, 2, 1]), np.array([10, 20, 30, 20, 10, 10, 40, 10]))
    assert found.tolist() == [1, -1, 0, 3, -1, 2, -1, -1]


def test_no_rating_is_joined_with_its_neighbours_one_by_one(spark):
    """A question is a row of arrays from one bucket to another, and so are the neighbours that cells find."""
    draw = random.Random(5)
    rows = [(u, p, float(draw.randint(1, 5)), draw.randint(1, 2)) for u in range(300) for p in range(12) if draw.random() < 0.6]
    estimates = fo.fold_estimates(fo.fold_neighbours(spark.createDataFrame(rows, RATED), 2), spark.createDataFrame(rows, RATED), 2)
    plan = estimates._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan[: plan.index("FlatMapGroupsInArrow")]
    assert "Window" not in plan


def test_few_cells_have_a_partition_each(spark):
    for blocks in (1, 3, 7, 9, 13):
        cells = [(a, b) for a in range(blocks) for b in range(a, blocks)]
        partitions = fo.lone_partitions(spark, blocks)
        assert partitions <= fo.SPREAD * blocks
        frame = spark.createDataFrame(cells, "tb int, ub int").repartition(partitions, "tb", "ub")
        most = frame.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert most == 1
