"""Ranking scored products per user, and presenting them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_n(scored: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` best products of each user, numbered from 1; ties go to the lower id.

    Spark keeps only the best ``n`` rows per user and task before it shuffles.
    """
    by_user = Window.partitionBy("user_id").orderBy(F.desc("score"), "product_id")
    return (
        scored.withColumn("pos", F.row_number().over(by_user))
        .where(F.col("pos") <= n)
        .select("user_id", "pos", "product_id", "score")
    )


def without_rated(pairs: DataFrame, ratings: DataFrame) -> DataFrame:
    """The (user, product) pairs the user has not rated."""
    rated = ratings.select("user_id", "product_id")
    return pairs.join(rated, ["user_id", "product_id"], "left_anti")


def in_catalogue(pairs: DataFrame, names: DataFrame) -> DataFrame:
    """The pairs whose product has a name."""
    return pairs.join(names.select("product_id"), "product_id", "left_semi")


def candidate_counts(targets: DataFrame, names: DataFrame, ratings: DataFrame) -> DataFrame:
    """How many catalogue products each target has rated and may still be recommended.

    The candidates themselves (every target with every unrated product) are only ever
    formed inside the scoring blocks; counting them needs the ratings alone.
    """
    users = targets.select("user_id").distinct()
    catalogue = names.select("product_id").distinct()
    n_products = catalogue.agg(F.count("*")).scalar()
    rated = (
        in_catalogue(ratings, catalogue).groupBy("user_id").agg(F.count("*").alias("n_rated"))
    )
    n_rated = F.coalesce("n_rated", F.lit(0))
    return users.join(rated, "user_id", "left").select(
        "user_id", n_rated.alias("n_rated"), (n_products - n_rated).alias("n_candidates")
    )


def with_names(recommendations: DataFrame, names: DataFrame) -> DataFrame:
    """Recommendations with product names; a product without one gets null."""
    return recommendations.join(names, "product_id", "left").select(
        *recommendations.columns, "name"
    )
