"""What a recommender is given: ratings and product names."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from kinrank.operators.quality import require_valid
from kinrank.sources.text import COLONS, PIPE, TAB, read_names, read_ratings


@dataclass(frozen=True)
class RatingData:
    """``ratings`` (user_id, product_id, rating) and ``names`` (product_id, name)."""

    ratings: DataFrame
    names: DataFrame

    @classmethod
    def checked(cls, ratings: DataFrame, names: DataFrame) -> RatingData:
        """Raises ``InvalidRatingsError`` when a rating is out of range or has no name."""
        return cls(require_valid(ratings, names), names)


def load_tab_separated(spark: SparkSession, ratings_path: str, names_path: str) -> RatingData:
    """Tab-separated ratings with pipe-separated names."""
    return RatingData.checked(
        read_ratings(spark, ratings_path, TAB), read_names(spark, names_path, PIPE)
    )


def load_colon_separated(spark: SparkSession, ratings_path: str, names_path: str) -> RatingData:
    """``::``-separated ratings and names."""
    return RatingData.checked(
        read_ratings(spark, ratings_path, COLONS), read_names(spark, names_path, COLONS)
    )
