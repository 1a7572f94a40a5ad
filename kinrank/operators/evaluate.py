"""Prediction errors.

``predictions`` are (user_id, product_id, prediction), ``test`` are (user_id, product_id,
rating); both unique per pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinrank.functions.scores import clamp
from kinrank.operators.splits import TEST, TRAIN, VALID


def predictions_vs_actuals(predictions: DataFrame, test: DataFrame) -> DataFrame:
    """Held-out rows that have a prediction."""
    return test.select("user_id", "product_id", "rating").join(
        predictions.select("user_id", "product_id", "prediction"), ["user_id", "product_id"]
    )


def _squared_error(clamped: bool = False) -> Column:
    prediction = clamp(F.col("prediction")) if clamped else F.col("prediction")
    error = prediction.cast("double") - F.col("rating")
    return error * error


def rmse_all_rows(predictions: DataFrame, test: DataFrame) -> DataFrame:
    """Root mean squared error over **all** held-out rows; a row without a prediction adds
    nothing to the error but counts in the mean. Null when no row has a prediction."""
    joined = test.select("user_id", "product_id", "rating").join(
        predictions.select("user_id", "product_id", "prediction"),
        ["user_id", "product_id"],
        "left",
    )
    total = F.sum(_squared_error())
    return joined.agg(
        F.sqrt(F.try_divide(total, F.count("*"))).alias("rmse"), F.count("*").alias("n")
    )


def rmse_scored_rows(
    predictions: DataFrame, test: DataFrame, clamped: bool = False
) -> DataFrame:
    """Root mean squared error over the held-out rows that have a prediction."""
    return predictions_vs_actuals(predictions, test).agg(
        F.sqrt(F.avg(_squared_error(clamped))).alias("rmse"), F.count("*").alias("n")
    )


def rmse_of_predicted(
    predicted: DataFrame, held_out: DataFrame | None = None, clamped: bool = False
) -> DataFrame:
    """The same for rows that carry both their rating and their prediction: no join.

    Over all rows of ``held_out`` if it is given, else over the predicted rows; null when
    nothing was predicted.
    """
    sums = predicted.agg(
        F.sum(_squared_error(clamped)).alias("_total"),
        F.count("*").alias("n"),
    )
    if held_out is not None:
        sums = sums.withColumn("n", held_out.agg(F.count("*")).scalar())
    return sums.select(F.sqrt(F.try_divide("_total", "n")).alias("rmse"), "n")


def mean_baseline(split: DataFrame) -> DataFrame:
    """Predict the mean of the training and validation ratings for every test row.

    ``split`` is labelled rows. One aggregation: the error of a constant m follows from
    the count, sum and sum of squares of the test ratings.
    """
    fitted = F.col("split").isin(TRAIN, VALID)
    tested = F.col("split") == TEST
    rating = F.col("rating").cast("double")
    sums = split.agg(
        F.avg(F.when(fitted, rating)).alias("mean_rating"),
        F.avg(F.when(tested, rating)).alias("_avg"),
        F.avg(F.when(tested, rating * rating)).alias("_avg_sq"),
        F.count_if(tested).alias("n"),
    )
    mean, avg = F.col("mean_rating"), F.col("_avg")
    squared = (mean - avg) * (mean - avg) + F.greatest(F.col("_avg_sq") - avg * avg, F.lit(0.0))
    return sums.select("mean_rating", F.sqrt(squared).alias("rmse"), "n")


def least_error(tried: DataFrame) -> DataFrame:
    """``tried`` with ``is_best``: the first row, by ``trial``, of the least ``rmse_valid``.

    Only finite errors compete: a model that scored nothing (null) or ran away (NaN,
    infinite) never wins. With none left every row is false.
    """
    error = F.col("rmse_valid")
    finite = error.isNotNull() & ~F.isnan(error) & (F.abs(error) < float("inf"))
    best = tried.where(finite).agg(F.min(F.struct("rmse_valid", "trial")).alias("best")).scalar()
    return tried.withColumn("is_best", F.coalesce(F.col("trial") == best.trial, F.lit(False)))


def improvement_pct(baseline: Column, model: Column) -> Column:
    """By how many percent the model's error is below the baseline's."""
    return (baseline - model) / baseline * 100
