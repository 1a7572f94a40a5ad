"""Errors of all folds at once against one fold after another."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinrank.operators import folds as fo
from kinrank.operators import neighbours as nb

SCHEMA = "user_id bigint, product_id bigint, rating double, fold int"


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(11)
    found = [
        (u, p, float(draw.randint(1, 5)), draw.randint(1, 4))
        for u in range(40)
        for p in range(25)
        if draw.random() < 0.4
    ]
    return found + [(99, p, float(1 + p % 5), 1 + p % 4) for p in range(25)] + [(98, 3, 2.0, 1)]


@pytest.fixture(scope="module")
def ratings(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).cache()


@pytest.mark.parametrize("block_users", [None, 9])
def test_neighbours_are_those_without_the_fold(ratings, block_users):
    found = fo.fold_neighbours(ratings, 4, 5, block_users).collect()
    for fold in range(1, 5):
        alone = nb.user_neighbours(ratings.where(F.col("fold") != fold), k=5).collect()
        want = {(r.user_id, r["rank"]): (r.neighbour_id, r.n, pytest.approx(r.sim, abs=1e-12)) for r in alone}
        got = {(r.user_id, r["rank"]): (r.neighbour_id, r.n, r.sim) for r in found if r.fold == fold}
        assert got == want


def test_errors_are_those_of_each_fold_alone(ratings):
    got = {r.fold: r for r in fo.knn_fold_errors(ratings, 4, 5).collect()}
    assert set(got) == {1, 2, 3, 4}
    for fold in got:
        train, test = ratings.where(F.col("fold") != fold), ratings.where(F.col("fold") == fold)
        estimates = nb.knn_estimate(nb.user_neighbours(train, k=5), train, test)
        joined = test.join(estimates, ["user_id", "product_id"], "left").collect()
        errors = [abs(r.score - r.rating) for r in joined if r.score is not None]
        assert got[fold].n_test == len(joined) and got[fold].n_scored == len(errors) > 0
        assert got[fold].mae == pytest.approx(np.mean(errors), abs=1e-9)


def test_cells_take_away_each_fold():
    draw = random.Random(5)
    sums, plain = fo.FoldSums(3), {}
    for _ in range(4):
        sides = []
        for base in (0, 100):
            some = [{base + draw.randrange(12): (float(draw.randint(1, 5)), draw.randint(1, 3)) for _ in range(6)} for _ in range(5)]
            sides.append(some)
        for u, v in zip(*sides):
            for a, (x, fx) in u.items():
                for b, (y, fy) in v.items():
                    for fold in range(4):
                        if fold == 0 or fold in (fx, fy):
                            plain.setdefault((fold, a, b), np.zeros(6))
                            plain[fold, a, b] += (1, x, y, x * x, y * y, x * y)
        args = []
        for some in sides:
            args += [
                np.array([i for s in some for i in s]),
                np.array([r for s in some for r, _ in s.values()]),
                np.array([f for s in some for _, f in s.values()]),
                np.array([len(s) for s in some]),
            ]
        sums.add_folds(*args)
    for who, others, parts in sums.in_order():
        for i, a in enumerate(who):
            for j, b in enumerate(others):
                for fold in range(4):
                    np.testing.assert_array_equal(parts[fold][:, i, j], plain.get((fold, a, b), np.zeros(6)))


def test_one_rating_and_no_ratings(spark):
    one = fo.knn_fold_errors(spark.createDataFrame([(1, 1, 3.0, 1)], SCHEMA), 2).collect()
    assert [(r.fold, r.n_test, r.n_scored, r.mae) for r in one] == [(1, 1, 0, None)]
    assert fo.knn_fold_errors(spark.createDataFrame([], SCHEMA), 2).collect() == []
