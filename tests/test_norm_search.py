"""The search bounded by norms against scoring everything."""

from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinrank.operators import als
from kinrank.operators import norm_search as ns

FACTORS = "id int, features array<float>"


def model_of(spark, users, products):
    frames = [
        spark.createDataFrame([(int(i), [float(x) for x in f]) for i, f in side.items()], FACTORS) for side in (users, products)
    ]
    return SimpleNamespace(userFactors=frames[0], itemFactors=frames[1], rank=len(next(iter(users.values()))))


def plain(users, products, names, rated, n):
    found = {}
    for u, f in users.items():
        scored = sorted((-float(np.float64(f) @ np.float64(products[p])), p) for p in names if p in products and (u, p) not in rated)
        found.update({(u, pos): p for pos, (_, p) in enumerate(scored[:n], 1)})
    return found


def factors(kind, rng, n, rank=4):
    base = rng.normal(size=(n, rank)).astype(np.float32)
    if kind == "skewed":
        base *= (1 / np.arange(1, n + 1)[:, None] ** 0.7).astype(np.float32)
    if kind == "grid":
        base = np.round(base).astype(np.float32)
    if kind == "equal norms":
        base /= np.linalg.norm(base, axis=1, keepdims=True)
    return dict(enumerate(base))


@pytest.fixture
def small_tiles(monkeypatch):
    monkeypatch.setattr(ns, "TILE_PRODUCTS", 7)
    monkeypatch.setattr(ns, "TILE_USERS", 11)


@pytest.mark.parametrize("kind", ["random", "skewed", "grid", "equal norms"])
def test_equals_scoring_everything(spark, kind, small_tiles):
    rng = np.random.default_rng(7)
    users, products = factors(kind, rng, 60), factors(kind, rng, 150)
    users[60] = np.zeros(4, dtype=np.float32)  # scores everything 0
    users[61] = -products[0]
    model = model_of(spark, users, products)
    rated = {(int(u), int(p)) for u, p in rng.integers(0, [60, 150], (900, 2))} | {(3, p) for p in range(150)}
    names = [*range(5, 150), 777]
    ratings = spark.createDataFrame([(u, p, 1.0) for u, p in rated], "user_id bigint, product_id bigint, rating double")
    catalogue = spark.createDataFrame([(p, "x") for p in names], "product_id int, name string")
    for exclude in (True, False):
        found = ns.bounded_recommend(
            model, ratings, catalogue, n=6, exclude_rated=exclude, block_users=20, band_products=16
        ).collect()
        want = plain(users, products, names, rated if exclude else set(), 6)
        assert {(r.user_id, r.pos): r.product_id for r in found} == want
        best = ns.best_possible(
            model, catalogue, spark.createDataFrame(found), ratings if exclude else ratings.limit(0), 6
        ).collect()
        assert len(best) == 62 and all(r.n_above == r.n_missing == 0 for r in best)
        everybody = {r.user_id: r.n_recommended for r in best}
        assert everybody[3] == (0 if exclude else 6)


def test_wrong_products_are_noticed(spark):
    rng = np.random.default_rng(8)
    users, products = factors("random", rng, 10), factors("random", rng, 40)
    model = model_of(spark, users, products)
    names = spark.createDataFrame([(p, "x") for p in range(40)], "product_id int, name string")
    nothing = spark.createDataFrame([], "user_id bigint, product_id bigint, rating double")
    right = ns.bounded_recommend(model, nothing, names, n=5, band_products=8)
    worst = right.select("user_id", "pos", ((F.col("product_id") + 1) % 40).cast("int").alias("product_id"), (F.col("score") - 1).alias("score"))
    assert all(r.n_above > 0 for r in ns.best_possible(model, names, worst, nothing, 5).collect())
    fewer = ns.best_possible(model, names, right.where("pos < 5"), nothing, 5).collect()
    assert all(r.n_missing == 1 and r.n_above == 0 for r in fewer)


def test_skewed_factors_skip_most_products(spark, small_tiles):
    rng = np.random.default_rng(9)
    users, products = factors("random", rng, 50), factors("skewed", rng, 1500)
    model = model_of(spark, users, products)
    names = spark.createDataFrame([(p, "x") for p in range(1500)], "product_id int, name string")
    nothing = spark.createDataFrame([], "user_id bigint, product_id bigint, rating double")
    found = ns.search_products(model, nothing, names, n=5, band_products=100)
    work = ns.search_work(found, names, model).collect()
    assert len(work) == 50 and all(r.scored + r.skipped == 1500 for r in work)
    assert sum(r.skipped for r in work) > 0.8 * 50 * 1500
    # No user is sent to a band they do not need.
    cells = found.where("scored IS NOT NULL").count()
    assert cells < 50 * 4


def test_recommendations_are_the_same_with_and_without_bounds(spark):
    rng = np.random.default_rng(10)
    users, products = factors("skewed", rng, 30), factors("skewed", rng, 90)
    model = model_of(spark, users, products)
    names = spark.createDataFrame([(p, "x") for p in range(90)], "product_id int, name string")
    ratings = spark.createDataFrame([(u, (7 * u) % 90, 1.0) for u in range(30)], "user_id bigint, product_id bigint, rating double")
    targets = spark.createDataFrame([(u,) for u in range(0, 30, 3)], "user_id bigint")
    for some in (None, targets):
        rows = [
            [(r.user_id, r.pos, r.product_id) for r in als.als_recommend(model, ratings, names, some, n=4, block_products=20, bounded=b).collect()]
            for b in (True, False)
        ]
        assert sorted(rows[0]) == sorted(rows[1]) and rows[0]


def test_no_users_and_no_products(spark):
    users, products = {1: np.ones(2, np.float32)}, {1: np.ones(2, np.float32)}
    model = model_of(spark, users, products)
    names = spark.createDataFrame([(5, "x")], "product_id int, name string")
    nothing = spark.createDataFrame([], "user_id bigint, product_id bigint, rating double")
    assert ns.bounded_recommend(model, nothing, names).collect() == []
    (row,) = ns.best_possible(model, names, ns.bounded_recommend(model, nothing, names), nothing, 10).collect()
    assert (row.n_recommended, row.n_above, row.n_missing) == (0, 0, 0)
    strangers = spark.createDataFrame([(9,)], "user_id bigint")
    names = spark.createDataFrame([(1, "x")], "product_id int, name string")
    assert ns.bounded_recommend(model, nothing, names, strangers).collect() == []


def test_a_user_leaves_a_search_as_n_rows_however_many_bands(spark):
    rng = np.random.default_rng(12)
    users, products = factors("equal norms", rng, 40), factors("equal norms", rng, 400)
    names = spark.createDataFrame([(p, "x") for p in range(400)], "product_id int, name string")
    nothing = spark.createDataFrame([], "user_id bigint, product_id bigint, rating double")
    found = ns.search_products(model_of(spark, users, products), nothing, names, n=5, band_products=100)
    assert found.where("product_id IS NOT NULL").count() == 40 * 5
    assert found.where("scored IS NOT NULL").count() == 40
