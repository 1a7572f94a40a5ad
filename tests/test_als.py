"""Factor models have no SQL to agree with; they are held to their definitions."""

import random
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinrank.operators import als
from kinrank.operators.evaluate import mean_baseline, rmse_all_rows
from kinrank.operators.quality import InvalidRatingsError, NoRatingsError, UnknownUserError
from kinrank.operators.recommenders import FactorRecommender
from kinrank.plans import factors as factor_plans
from kinrank.plans.factors import _solved
from kinrank.sources.provider import RatingData

PARAMETERS = {"rank": 4, "iterations": 5, "regularisation": 0.1}


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(3)
    rated = [
        (u, p, float(1 + (u * p + draw.randint(0, 1)) % 5))
        for u in range(30)
        for p in range(20)
        if draw.random() < 0.5
    ]
    return rated + [(99, p, float(1 + p % 5)) for p in range(20)]  # has rated everything


@pytest.fixture(scope="module")
def ratings(spark, rows):
    return spark.createDataFrame(rows, "user_id bigint, product_id bigint, rating double").cache()


@pytest.fixture(scope="module")
def names(spark):
    # product 19 is not in the catalogue, product 50 has no ratings
    ids = [*range(19), 50]
    return spark.createDataFrame([(p, f"p{p}") for p in ids], "product_id int, name string")


@pytest.fixture(scope="module")
def model(ratings):
    return als.als_fit(ratings, **PARAMETERS)


@pytest.fixture(scope="module")
def factors(model):
    return [
        {r["id"]: np.array(r["features"]) for r in frame.collect()}
        for frame in (model.userFactors, model.itemFactors)
    ]


def ranked(factors, names, skip, n):
    users, products = factors
    found = {}
    for u, f in users.items():
        scored = [
            (-float(f @ products[p]), p)
            for p in names
            if p in products and (u, p) not in skip
        ]
        for pos, (minus, p) in enumerate(sorted(scored)[:n], 1):
            found[u, pos] = (p, pytest.approx(-minus, abs=1e-4))
    return found


def as_ranked(frame):
    return {(r["user_id"], r["pos"]): (r["product_id"], r["score"]) for r in frame.collect()}


def test_prediction_is_the_product_of_factors(model, ratings, factors):
    users, products = factors
    for r in als.als_predict(model, ratings).collect():
        expected = float(users[r["user_id"]] @ products[r["product_id"]])
        assert r["prediction"] == pytest.approx(expected, abs=1e-4)


def test_unknown_users_and_products_drop_out(spark, model):
    pairs = spark.createDataFrame([(1, 1), (1, 777), (777, 1)], "user_id int, product_id int")
    assert als.als_predict(model, pairs).count() == 1


def test_ids_beyond_int_fail(spark):
    ratings = spark.createDataFrame([(2**40, 1, 1.0)], "user_id bigint, product_id int, rating double")
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        als.als_fit(ratings, **PARAMETERS)


def test_same_seed_same_model(ratings, model):
    again = als.als_fit(ratings.repartition(5), **PARAMETERS)
    first = {r["id"]: r["features"] for r in model.userFactors.collect()}
    second = {r["id"]: r["features"] for r in again.userFactors.collect()}
    assert first.keys() == second.keys()
    for user in first:
        assert second[user] == pytest.approx(first[user], abs=1e-3)


@pytest.mark.parametrize(
    "tile, blocks", [(25, {}), (4_000_000, {"block_users": 7, "block_products": 6})]
)
def test_recommend(model, ratings, rows, names, factors, tile, blocks, monkeypatch):
    monkeypatch.setattr(als, "TILE_SCORES", tile)
    catalogue = [r["product_id"] for r in names.collect()]
    rated = {(u, p) for u, p, _ in rows}
    found = als.als_recommend(model, ratings, names, n=5, **blocks)
    assert as_ranked(found) == ranked(factors, catalogue, rated, 5)
    assert not [u for u, _ in as_ranked(found) if u == 99]
    found = als.als_recommend(model, ratings, names, n=30, exclude_rated=False, **blocks)
    assert as_ranked(found) == ranked(factors, catalogue, set(), 30)


def test_recommend_for_targets(spark, model, ratings, names):
    targets = spark.createDataFrame([(3,), (4,), (1234,)], "user_id bigint")
    some = as_ranked(als.als_recommend(model, ratings, names, targets, n=5))
    every = as_ranked(als.als_recommend(model, ratings, names, n=5))
    assert some == {key: value for key, value in every.items() if key[0] in (3, 4)}


def test_adhoc(frame, ratings, names):
    mine = frame([(-1, p, float(p % 6)) for p in range(8)] + [(-2, 3, 5.0)])
    found = als.als_recommend_adhoc(ratings, mine, names, 5, **PARAMETERS).collect()
    assert {r["user_id"] for r in found} == {-1, -2}
    given = {-1: {p for p in range(8) if p % 6}, -2: {3}}
    assert all(r["product_id"] not in given[r["user_id"]] for r in found)
    with pytest.raises(NoRatingsError):
        als.als_recommend_adhoc(ratings, frame([(-1, 1, 0.0)]), names, **PARAMETERS)
    with pytest.raises(ValueError, match="already"):
        als.als_recommend_adhoc(ratings, frame([(3, 1, 5.0)]), names, **PARAMETERS)


def test_training_error_beats_the_mean(model, ratings):
    fitted = rmse_all_rows(als.als_predict(model, ratings), ratings).first()["rmse"]
    labelled = ratings.withColumn("split", F.lit("train")).union(
        ratings.withColumn("split", F.lit("test"))
    )
    assert fitted < mean_baseline(labelled).first()["rmse"]


def test_grid(frame, rows):
    parts = [frame(r for i, r in enumerate(rows) if i % 5 in keep) for keep in ((0, 1, 2), (3,), (4,))]
    found = als.als_grid(*parts, ranks=(2, 4), regularisations=(0.1, 10.0), iterations=(3,))
    tried = found.collect()
    assert [(r["rank"], r["reg"]) for r in tried] == [(2, 0.1), (2, 10.0), (4, 0.1), (4, 10.0)]
    best = min(tried, key=lambda r: r["rmse_valid"])
    assert [r for r in tried if r["is_best"]] == [best]
    assert [r for r in tried if r["rmse_test"] is not None] == [best]


def test_implicit(frame, rows):
    labelled = frame(
        [(*r, "test" if i % 5 == 0 else "train") for i, r in enumerate(rows)],
        "user_id bigint, product_id bigint, rating double, split string",
    )
    found = als.als_implicit_rmse(labelled, **PARAMETERS).first()
    assert 0 < found["rmse"] < 1 and found["n"] > 0


def test_recommender(spark, frame, ratings, names):
    data = RatingData(ratings, names)
    recommender = FactorRecommender(data, rank=4, regularisation=0.1, iterations=3)
    known = spark.createDataFrame([(3,)], "user_id bigint")
    mixed = spark.createDataFrame([(3,), (-7,)], "user_id bigint")
    one = as_ranked(recommender.recommend_for_users(known, 4))
    assert len(one) == 4
    assert one == as_ranked(recommender.recommend_for_users(mixed, 4, on_unknown="drop"))
    with pytest.raises(UnknownUserError):
        recommender.recommend_for_users(mixed)
    mine = frame([(-1, p, float(p % 6)) for p in range(8)])
    assert recommender.recommend_from_ratings(mine, 3).count() == 3
    assert recommender.evaluate().first()["rmse"] > 0


def test_cache_is_released(spark, ratings, names):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    als.als_grid(ratings, ratings, ratings, iterations=(2,)).collect()
    after = spark.sparkContext._jsc.getPersistentRDDs()
    # what remains are factors, which Spark drops with their model
    assert all("Factors" in str(rdd.name()) for rdd in list(after.values())[before:])


def test_block_counts_are_passed_on(ratings, model):
    other = als.als_fit(ratings, **PARAMETERS, user_blocks=3, product_blocks=2)
    assert other.userFactors.count() == model.userFactors.count()
    assert other.userFactors.rdd.getNumPartitions() == 3
    assert other.itemFactors.rdd.getNumPartitions() == 2


def test_a_grid_in_which_nothing_is_scored_raises(frame, rows):
    strangers = frame([(5000, 1, 3.0), (5001, 2, 3.0)])
    with pytest.raises(ValueError, match="finite"):
        als.als_grid(frame(rows), strangers, strangers, ranks=(2,), iterations=(1,))


def test_blocks_follow_the_ratings(monkeypatch, ratings):
    asked = {}

    class Asked(als.ALS):
        def __init__(self, **parameters):
            asked.update(parameters)
            super().__init__(**parameters)

    monkeypatch.setattr(als, "ALS", Asked)
    monkeypatch.setattr(als, "RATINGS_PER_BLOCK", 10)
    als.als_fit(ratings, rank=2, iterations=1)
    assert asked["numUserBlocks"] == asked["numItemBlocks"] == -(-ratings.count() // 10)
    als.als_fit(ratings, rank=2, iterations=1, user_blocks=3, product_blocks=2)
    assert (asked["numUserBlocks"], asked["numItemBlocks"]) == (3, 2)


def test_many_ratings_do_not_copy_factors_to_many_blocks(monkeypatch, spark, ratings):
    asked = {}

    class Asked(als.ALS):
        def __init__(self, **parameters):
            asked.update(parameters)
            super().__init__(**parameters)

    few = ratings.limit(50)
    monkeypatch.setattr(als, "ALS", Asked)
    monkeypatch.setattr(type(few), "count", lambda frame: 35_212_260)
    als.als_fit(few, rank=2, iterations=1)
    assert asked["numUserBlocks"] == asked["numItemBlocks"] == spark.sparkContext.defaultParallelism


@pytest.mark.parametrize("swapped", [False, True])
def test_the_larger_side_is_copied_to_half_as_many_blocks(spark, frame, swapped):
    cores = spark.sparkContext.defaultParallelism
    pairs = [(u, (u * 7 + i * 3) % 20) for u in range(400) for i in range(15)]
    many = frame((*(pair[::-1] if swapped else pair), float(1 + sum(pair) % 5)) for pair in pairs)
    blocks = (cores, cores // 2)[:: -1 if swapped else 1]
    fitted = als.als_fit(many, rank=10, iterations=10, regularisation=0.1)
    assert tuple(f.rdd.getNumPartitions() for f in (fitted.userFactors, fitted.itemFactors)) == blocks
    found = _solved(fitted, many, 0.1, F.lit(1.0), F.col("rating"), F.lit(1)).collect()
    assert {r["solved"] for r in found} == {True} and sum(r["n_ratings"] for r in found) == len(pairs)
    # one iteration copies less than the ratings weigh: every core has a block
    assert als._blocks(many, 10, 1) == (cores, cores)


def test_blocks_are_not_halved_beyond_memory(monkeypatch, frame):
    many = frame((u, (u * 7 + i * 3) % 20, 3.0) for u in range(400) for i in range(15))
    monkeypatch.setattr(als, "RATINGS_PER_BLOCK", 100)
    assert als._blocks(many, 10, 10) == (60, 60)


def test_an_impossible_mark_is_refused(frame, ratings, names):
    with pytest.raises(InvalidRatingsError):
        als.als_recommend_adhoc(ratings, frame([(-1, 1, 6.0), (-1, 2, 4.0)]), names, **PARAMETERS)


def test_unsolved_normal_equations_are_noticed(model, ratings):
    def solved(user_factors):
        fitted = SimpleNamespace(rank=model.rank, userFactors=user_factors, itemFactors=model.itemFactors)
        rating = F.col("rating")
        found = _solved(fitted, ratings, PARAMETERS["regularisation"], F.lit(1.0), rating, F.lit(1))
        return {r["solved"] for r in found.collect()}

    assert solved(model.userFactors) == {True}
    off = F.transform("features", lambda x: x * 1.05)
    assert False in solved(model.userFactors.withColumn("features", off))


@pytest.mark.parametrize("implicit", [False, True])
def test_equations_are_checked_user_by_user(monkeypatch, spark, frame, implicit):
    monkeypatch.setattr(factor_plans, "AT_ONCE", 7)
    rng = np.random.default_rng(5)
    users = {u: rng.normal(size=3).astype(np.float32) for u in range(40)}
    products = {p: rng.normal(size=3).astype(np.float32) for p in range(12)}
    gram = sum(np.outer(v, v) for v in products.values()) if implicit else np.zeros((3, 3))
    rows = [(u, p, float(rng.integers(-2, 3))) for u in range(40) for p in range(12) if rng.random() < 0.5]
    for u in range(0, 40, 2):  # every other user gets the solution
        mine = [(products[p].astype(float), r) for x, p, r in rows if x == u]
        matrix = gram + 0.3 * sum((r > 0) if implicit else 1 for _, r in mine) * np.eye(3)
        matrix = matrix + sum((abs(r) if implicit else 1) * np.outer(v, v) for v, r in mine)
        right = sum(((1 + abs(r)) * (r > 0) if implicit else r) * v for v, r in mine)
        users[u] = np.linalg.solve(matrix, right).astype(np.float32)
    rows += [(77, 0, 1.0), (3, 99, 1.0)]  # nobody knows this user, or this product

    def side(factors):
        return spark.createDataFrame([(k, v.tolist()) for k, v in factors.items()], "id int, features array<float>")

    rating = F.col("rating")
    liked = rating > 0
    terms = (
        (F.abs("rating"), F.when(liked, 1 + F.abs("rating")).otherwise(0.0), liked, gram.tolist())
        if implicit
        else (F.lit(1.0), rating, F.lit(1))
    )
    model = SimpleNamespace(rank=3, userFactors=side(users), itemFactors=side(products))
    checked = _solved(model, frame(rows), 0.3, *terms)
    assert [f.dataType.simpleString() for f in checked.schema] == ["bigint", "bigint", "boolean"]
    found = {r.user_id: (r.n_ratings, r.solved) for r in checked.collect()}
    assert found == {u: (sum(x == u and p < 12 for x, p, _ in rows), u % 2 == 0) for u in range(40)}
    # factors meet the pairs of block and product, not ratings one by one
    plan = checked._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and "FlatMapCoGroupsInArrow" in plan
