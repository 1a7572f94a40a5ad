"""Error measures, on a predictor SQL can express.

It predicts a user's mean training rating of a family of four neighbouring products, so
held-out rows of a family the user has no training rating in stay without a prediction.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from kinrank.functions.scores import binary_label, clamp, implicit_shift
from kinrank.operators import evaluate, splits
from kinrank.plans.registry import query
from kinrank.plans.sql import HASHED, RATINGS, with_
from kinrank.session import written
from kinrank.sources import tables

_PREDICTED = """
family AS (
  SELECT user_id, product_id // 4 AS family, avg(rating) AS prediction
  FROM hashed WHERE digit < 8 GROUP BY 1, 2),
predicted AS (
  SELECT h.user_id, h.product_id, h.rating, prediction
  FROM hashed AS h LEFT JOIN family AS f
    ON f.user_id = h.user_id AND f.family = h.product_id // 4
  WHERE digit >= 8)"""


def _family_means(train, pairs):
    family = F.floor(F.col("product_id") / 4).cast("int")
    means = train.groupBy("user_id", family.alias("family")).agg(
        F.avg("rating").alias("prediction")
    )
    return (
        pairs.select("user_id", "product_id", family.alias("family"))
        .join(means, ["user_id", "family"])
        .select("user_id", "product_id", "prediction")
    )


def _ratings(spark, folder):
    """Both parts of a split read them, so they are derived from the events once."""
    return written(tables.event_ratings(spark, folder))


def _hashed_parts(spark, folder):
    split = splits.split_hash(_ratings(spark, folder), 8)
    train = split.where(F.col("split") == splits.TRAIN)
    test = split.where(F.col("split") == splits.TEST)
    return train, test


def _predicted(spark, folder):
    train, test = _hashed_parts(spark, folder)
    return _family_means(train, test), test


@query(
    with_(RATINGS, HASHED, _PREDICTED)
    + """SELECT user_id, product_id, rating, round(prediction, 6) AS prediction
FROM predicted WHERE prediction IS NOT NULL"""
)
def predictions_vs_actuals(spark, folder):
    joined = evaluate.predictions_vs_actuals(*_predicted(spark, folder))
    return joined.withColumn("prediction", F.round("prediction", 6))


@query(
    with_(RATINGS, HASHED, _PREDICTED)
    + """SELECT round(sqrt(sum((prediction - rating) * (prediction - rating)) / count(*)), 6)
       AS rmse, count(*) AS n FROM predicted"""
)
def rmse_all_rows(spark, folder):
    return evaluate.rmse_all_rows(*_predicted(spark, folder)).withColumn(
        "rmse", F.round("rmse", 6)
    )


@query(
    with_(RATINGS, HASHED, _PREDICTED)
    + """SELECT round(sqrt(avg((prediction - rating) * (prediction - rating))), 6) AS rmse,
       count(prediction) AS n FROM predicted"""
)
def rmse_scored_rows(spark, folder):
    return evaluate.rmse_scored_rows(*_predicted(spark, folder)).withColumn(
        "rmse", F.round("rmse", 6)
    )


@query(
    with_(RATINGS)
    + """SELECT user_id, product_id, rating, ts_s,
       CAST(rating AS DOUBLE) - CAST(2.5 AS DOUBLE) AS confidence FROM ratings"""
)
def implicit_shift_(spark, folder):
    return tables.event_ratings(spark, folder).withColumn(
        "confidence", implicit_shift(F.col("rating").cast("double"))
    )


@query(
    with_(RATINGS, HASHED)
    + """SELECT user_id, product_id,
       CASE WHEN rating - 2.5 > 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS label
FROM hashed WHERE digit >= 8"""
)
def implicit_labels(spark, folder):
    _, test = _hashed_parts(spark, folder)
    return test.select(
        "user_id", "product_id", binary_label(implicit_shift(F.col("rating"))).alias("label")
    )


@query(
    with_(RATINGS, HASHED, _PREDICTED)
    + """SELECT user_id, product_id,
       round(GREATEST(LEAST(prediction - CAST(2.5 AS DOUBLE), CAST(1 AS DOUBLE)),
                      CAST(0 AS DOUBLE)), 6) AS clamped
FROM predicted WHERE prediction IS NOT NULL"""
)
def clamp_predictions(spark, folder):
    predictions, _ = _predicted(spark, folder)
    clamped = clamp(implicit_shift(F.col("prediction")))
    return predictions.select("user_id", "product_id", F.round(clamped, 6).alias("clamped"))


_BASELINE = """
mean_rating AS (SELECT avg(rating) AS m FROM ratings WHERE ts_s % 10 <= 4),
baseline AS (
  SELECT m AS mean_rating, sqrt(avg((m - rating) * (m - rating))) AS rmse, count(*) AS n
  FROM ratings, mean_rating WHERE ts_s % 10 = 5 GROUP BY m)"""


@query(
    with_(RATINGS, _BASELINE)
    + "SELECT round(mean_rating, 6) AS mean_rating, round(rmse, 6) AS rmse, n FROM baseline"
)
def mean_baseline(spark, folder):
    split = splits.split_ts_digit(tables.event_ratings(spark, folder))
    return evaluate.mean_baseline(split).select(
        F.round("mean_rating", 6).alias("mean_rating"), F.round("rmse", 6).alias("rmse"), "n"
    )


@query(
    with_(
        RATINGS,
        _BASELINE,
        """
family AS (
  SELECT user_id, product_id // 4 AS family, avg(rating) AS prediction
  FROM ratings WHERE ts_s % 10 <= 3 GROUP BY 1, 2),
model AS (
  SELECT sqrt(sum((prediction - rating) * (prediction - rating)) / count(*)) AS rmse
  FROM ratings AS r LEFT JOIN family AS f
    ON f.user_id = r.user_id AND f.family = r.product_id // 4
  WHERE ts_s % 10 = 5)""",
    )
    + """SELECT round(b.rmse, 6) AS baseline_rmse, round(m.rmse, 6) AS model_rmse,
       round((b.rmse - m.rmse) / b.rmse * 100, 6) AS improvement_pct
FROM baseline AS b, model AS m"""
)
def improvement_pct(spark, folder):
    split = splits.split_ts_digit(_ratings(spark, folder))
    train = split.where(F.col("split") == splits.TRAIN)
    test = split.where(F.col("split") == splits.TEST)
    baseline = evaluate.mean_baseline(split).select("rmse").scalar()
    model = evaluate.rmse_all_rows(_family_means(train, test), test)
    return model.select(baseline.alias("b"), F.col("rmse").alias("m")).select(
        F.round("b", 6).alias("baseline_rmse"),
        F.round("m", 6).alias("model_rmse"),
        F.round(evaluate.improvement_pct(F.col("b"), F.col("m")), 6).alias("improvement_pct"),
    )


_TRIED = """
family AS (
  SELECT user_id, product_id // 4 AS family, sum(rating) AS total, count(*) AS n
  FROM ratings WHERE ts_s % 10 <= 3 GROUP BY 1, 2),
middle AS (SELECT avg(rating) AS m FROM ratings WHERE ts_s % 10 <= 3),
grid(trial, reg) AS (VALUES (0, 0.1::DOUBLE), (1, 10.0::DOUBLE)),
shrunk AS (
  SELECT trial, reg, rating, (total + reg * m) / (n + reg) AS prediction
  FROM grid, middle, ratings AS r LEFT JOIN family AS f
    ON f.user_id = r.user_id AND f.family = r.product_id // 4
  WHERE ts_s % 10 = 4),
tried AS (
  SELECT trial, reg, sqrt(sum((prediction - rating) * (prediction - rating)) / count(*)) AS error
  FROM shrunk GROUP BY trial, reg)"""


@query(
    with_(RATINGS, _TRIED)
    + """SELECT trial, reg, round(error, 6) AS rmse_valid,
       row_number() OVER (ORDER BY error, trial) = 1 AS is_best FROM tried"""
)
def grid_choice(spark, folder):
    """The better of two weights of the overall mean in a user's family means."""
    split = splits.split_ts_digit(_ratings(spark, folder))
    train = split.where(F.col("split") == splits.TRAIN)
    valid = split.where(F.col("split") == splits.VALID)
    family = F.floor(F.col("product_id") / 4).cast("int")
    sums = train.groupBy("user_id", family.alias("family")).agg(
        F.sum("rating").alias("total"), F.count("*").alias("n")
    )
    middle = train.agg(F.avg("rating")).scalar()
    pairs = valid.select("user_id", "product_id", family.alias("family")).join(
        sums, ["user_id", "family"]
    )
    tried = None
    for trial, reg in enumerate((0.1, 10.0)):
        shrunk = (F.col("total") + reg * middle) / (F.col("n") + reg)
        error = evaluate.rmse_all_rows(pairs.withColumn("prediction", shrunk), valid)
        row = error.select(
            F.lit(trial).alias("trial"), F.lit(reg).alias("reg"), F.col("rmse").alias("rmse_valid")
        )
        tried = row if tried is None else tried.unionByName(row)
    return evaluate.least_error(tried).withColumn("rmse_valid", F.round("rmse_valid", 6))
