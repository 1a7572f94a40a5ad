"""Two recommenders with the same three methods."""

from __future__ import annotations

from abc import ABC, abstractmethod

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinrank.operators import als, neighbours
from kinrank.operators.evaluate import rmse_of_predicted
from kinrank.operators.quality import known_targets, require_adhoc
from kinrank.operators.splits import TEST, TRAIN, split_hash
from kinrank.sources.provider import RatingData


class Recommender(ABC):
    """Recommendations are (user_id, pos, product_id, score) for a frame of targets."""

    def __init__(self, data: RatingData):
        self.data = data

    @abstractmethod
    def recommend_from_ratings(self, adhoc: DataFrame, n: int = 10) -> DataFrame:
        """For people who bring their own ratings."""

    @abstractmethod
    def recommend_for_users(
        self, targets: DataFrame, n: int = 10, on_unknown: str = "raise"
    ) -> DataFrame:
        """For users who have ratings; see ``known_targets`` for ``on_unknown``."""

    @abstractmethod
    def evaluate(self) -> DataFrame:
        """The error on held-out ratings."""


class NeighbourhoodRecommender(Recommender):
    def recommend_from_ratings(self, adhoc, n=10):
        return neighbours.knn_recommend(
            self.data.ratings, n=n, target_ratings=require_adhoc(adhoc)
        )

    def recommend_for_users(self, targets, n=10, on_unknown="raise"):
        known = known_targets(targets, self.data.ratings, on_unknown)
        return neighbours.knn_recommend(self.data.ratings, known, n)

    def evaluate(self):
        return neighbours.knn_mae(self.data.ratings)


class FactorRecommender(Recommender):
    def __init__(self, data: RatingData, rank: int, regularisation: float, iterations: int):
        super().__init__(data)
        self.parameters = {
            "rank": rank,
            "regularisation": regularisation,
            "iterations": iterations,
        }
        self.model = als.als_fit(data.ratings, **self.parameters)

    def recommend_from_ratings(self, adhoc, n=10):
        return als.als_recommend_adhoc(
            self.data.ratings, adhoc, self.data.names, n, **self.parameters
        )

    def recommend_for_users(self, targets, n=10, on_unknown="raise"):
        known = known_targets(targets, self.data.ratings, on_unknown)
        return als.als_recommend(self.model, self.data.ratings, self.data.names, known, n)

    def evaluate(self):
        split = split_hash(self.data.ratings)
        train = split.where(F.col("split") == TRAIN)
        test = split.where(F.col("split") == TEST)
        model = als.als_fit(train, **self.parameters)
        return rmse_of_predicted(als.als_predict(model, test))
