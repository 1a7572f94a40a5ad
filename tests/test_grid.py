"""Trials of a grid at the same time."""

import threading
import time

import pytest

from kinrank.operators import als

RATED = "user_id bigint, product_id bigint, rating double"


@pytest.fixture(scope="module")
def parts(spark):
    rows = [(u, p, float(1 + (u * p) % 5)) for u in range(20) for p in range(15) if (u + p) % 3]
    return [spark.createDataFrame([r for i, r in enumerate(rows) if i % 5 in keep], RATED) for keep in ((0, 1, 2), (3,), (4,))]


class Fake:
    def __init__(self, key):
        self.key = key


@pytest.fixture
def fake(monkeypatch, spark):
    """Fits that take as long, and have the errors, that a test says."""
    running, most, lock = [0], [0], threading.Lock()

    def set_up(errors, seconds):
        def fit(train, rank, iters, reg, seed):
            with lock:
                running[0] += 1
                most[0] = max(most[0], running[0])
            time.sleep(seconds[rank])
            with lock:
                running[0] -= 1
            if isinstance(errors[rank], Exception):
                raise errors[rank]
            return Fake(rank)

        def rmse(predicted, held_out=None, clamped=False):
            return spark.createDataFrame([(predicted, 1)], "rmse double, n bigint")

        monkeypatch.setattr(als, "als_fit", fit)
        monkeypatch.setattr(als, "als_predict", lambda model, pairs: errors[model.key])
        monkeypatch.setattr(als, "rmse_of_predicted", rmse)
        return most

    return set_up


@pytest.mark.parametrize("seconds", [{1: 0, 2: 0.2, 3: 0.4}, {1: 0.4, 2: 0.2, 3: 0}])
def test_the_first_of_equals_wins_whoever_finishes_first(parts, fake, seconds):
    most = fake({1: 2.0, 2: 1.0, 3: 1.0}, seconds)
    rows = als.als_grid(*parts, ranks=(1, 2, 3), regularisations=(0.1,), iterations=(1,), at_once=3).collect()
    assert [(r["rank"], r["is_best"]) for r in rows] == [(1, False), (2, True), (3, False)]
    assert rows[1]["rmse_test"] == 1.0 and most[0] > 1


def test_one_at_a_time(parts, fake):
    most = fake({1: 2.0, 2: float("nan"), 3: None}, {1: 0.05, 2: 0.05, 3: 0.05})
    rows = als.als_grid(*parts, ranks=(1, 2, 3), regularisations=(0.1,), iterations=(1,), at_once=1).collect()
    assert most[0] == 1 and [r["is_best"] for r in rows] == [True, False, False]


def test_a_failed_trial_cancels_the_others(spark, parts, monkeypatch):
    started = threading.Event()
    fit = als.als_fit

    def failing(train, rank, iters, reg, seed):
        if rank == 1:
            started.wait(20)
            time.sleep(0.5)
            raise RuntimeError("out of luck")
        started.set()
        # A job that takes far longer than the test may.
        spark.range(0, 10**13, 1, 4).selectExpr("sum(id % 7)").collect()
        return fit(train, rank, iters, reg, seed=seed)

    monkeypatch.setattr(als, "als_fit", failing)
    began = time.time()
    with pytest.raises(RuntimeError, match="out of luck"):
        als.als_grid(*parts, ranks=(1, 2), regularisations=(0.1,), iterations=(1,), at_once=2)
    assert time.time() - began < 30
    assert spark.range(5).count() == 5  # the caller's own jobs go on


def test_same_table_as_one_after_another(parts):
    points = {"ranks": (2, 3), "regularisations": (0.1, 10.0), "iterations": (2,)}
    together, alone = (als.als_grid(*parts, **points, at_once=n).collect() for n in (4, 1))
    assert [(r["rank"], r["reg"], r["iters"], r["is_best"]) for r in together] == [
        (r["rank"], r["reg"], r["iters"], r["is_best"]) for r in alone
    ]
    for a, b in zip(together, alone):
        assert a["rmse_valid"] == pytest.approx(b["rmse_valid"], abs=1e-4)
