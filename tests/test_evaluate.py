import math

import pytest
from pyspark.sql import functions as F

from kinrank.functions import scores
from kinrank.operators import evaluate as e
from kinrank.operators.topn import candidate_counts, in_catalogue, top_n, with_names, without_rated

PREDICTIONS = "user_id bigint, product_id bigint, prediction double"


def test_a_cold_row_tells_the_two_errors_apart(frame):
    test = frame([(1, 1, 3.0), (1, 2, 5.0), (2, 1, 1.0)])
    predictions = frame([(1, 1, 4.0), (1, 2, 3.0), (9, 9, 1.0)], PREDICTIONS)
    every = e.rmse_all_rows(predictions, test).first()
    scored = e.rmse_scored_rows(predictions, test).first()
    assert (every["rmse"], every["n"]) == (pytest.approx(math.sqrt(5 / 3)), 3)
    assert (scored["rmse"], scored["n"]) == (pytest.approx(math.sqrt(5 / 2)), 2)


def test_predicted_rows_need_no_join(frame):
    test = frame([(1, 1, 3.0), (1, 2, 5.0), (2, 1, 1.0)])
    predictions = frame([(1, 1, 4.0), (1, 2, 3.0)], PREDICTIONS)
    predicted = test.join(predictions, ["user_id", "product_id"])
    every, scored = e.rmse_of_predicted(predicted, test), e.rmse_of_predicted(predicted)
    assert every.collect() == e.rmse_all_rows(predictions, test).collect()
    assert scored.collect() == e.rmse_scored_rows(predictions, test).collect()
    assert e.rmse_of_predicted(predicted.limit(0), test).first()["rmse"] is None
    assert e.rmse_of_predicted(predicted.limit(0)).first()["rmse"] is None


def test_clamped_error(frame):
    test = frame([(1, 1, 1.0), (1, 2, 0.0)])
    predictions = frame([(1, 1, 1.7), (1, 2, -0.5)], PREDICTIONS)
    assert e.rmse_scored_rows(predictions, test, clamped=True).first()["rmse"] == 0.0


def test_nothing_to_score(frame):
    test, predictions = frame([(1, 1, 1.0)]), frame([], PREDICTIONS)
    assert e.rmse_all_rows(predictions, test).first()["rmse"] is None
    assert e.rmse_scored_rows(predictions, test).first()["rmse"] is None
    assert e.rmse_all_rows(predictions, frame([])).first()["rmse"] is None


def test_scalars(spark):
    numbers = spark.createDataFrame([(-0.2,), (0.4,), (1.3,)], "x double")
    assert [r[0] for r in numbers.select(scores.clamp(F.col("x"))).collect()] == [0.0, 0.4, 1.0]
    ratings = spark.createDataFrame([(float(r),) for r in range(1, 6)], "r double")
    shifted = scores.implicit_shift(F.col("r"))
    rows = ratings.select(shifted, scores.binary_label(shifted)).collect()
    assert [r[0] for r in rows] == [-1.5, -0.5, 0.5, 1.5, 2.5]
    assert [r[1] for r in rows] == [0.0, 0.0, 1.0, 1.0, 1.0]


def test_mean_baseline(frame):
    rows = [(1, 1, 1.0, "train"), (1, 2, 3.0, "valid"), (1, 3, 5.0, "test"), (1, 4, 2.0, "test")]
    rows.append((1, 5, 100.0, None))
    split = frame(rows, "user_id bigint, product_id bigint, rating double, split string")
    found = e.mean_baseline(split).first()
    assert (found["mean_rating"], found["n"]) == (2.0, 2)
    assert found["rmse"] == pytest.approx(math.sqrt((9 + 0) / 2))


def test_improvement(spark):
    found = spark.range(1).select(e.improvement_pct(F.lit(2.0), F.lit(1.5))).first()[0]
    assert found == 25.0


def test_top_n_breaks_ties_by_product(frame):
    scored = frame(
        [(1, 3, 2.0), (1, 2, 2.0), (1, 1, 1.0), (2, 9, 0.0)],
        "user_id bigint, product_id bigint, score double",
    )
    assert sorted(map(tuple, top_n(scored, 2).collect())) == [
        (1, 1, 2, 2.0),
        (1, 2, 3, 2.0),
        (2, 1, 9, 0.0),
    ]


def test_candidates(spark, frame):
    ratings = frame([(1, 1, 5.0), (1, 2, 5.0), (1, 77, 5.0), (2, 1, 5.0)])
    names = spark.createDataFrame([(p, f"p{p}") for p in (1, 2, 3)], "product_id bigint, name string")
    targets = spark.createDataFrame([(1,), (1,), (8,)], "user_id bigint")
    found = sorted(map(tuple, candidate_counts(targets, names, ratings).collect()))
    assert found == [(1, 2, 1), (8, 0, 3)]
    assert without_rated(frame([(1, 1, 0.0), (1, 3, 0.0)]), ratings).count() == 1
    assert in_catalogue(ratings, names).count() == 3


def test_a_missing_name_is_null(spark, frame):
    names = spark.createDataFrame([(1, "one")], "product_id bigint, name string")
    recs = frame([(1, 1, 5.0), (1, 2, 4.0)], "user_id bigint, product_id bigint, score double")
    named = {r["product_id"]: r["name"] for r in with_names(top_n(recs), names).collect()}
    assert named == {1: "one", 2: None}


def test_only_finite_errors_compete(spark):
    schema = "trial int, rmse_valid double"
    tried = spark.createDataFrame([(0, float("nan")), (1, None), (2, 0.5), (3, 0.5), (4, float("inf"))], schema)
    assert {r["trial"]: r["is_best"] for r in e.least_error(tried).collect()} == {
        0: False, 1: False, 2: True, 3: False, 4: False,
    }
    none = spark.createDataFrame([(0, float("nan")), (1, None)], schema)
    assert not any(r["is_best"] for r in e.least_error(none).collect())
