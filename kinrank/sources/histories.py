"""A store of ratings in which one user's are found without reading the others'.

The ratings are a table dealt into buckets by user. A lookup of some users reads their
buckets alone, and a join by user needs no exchange of the ratings, so what has been
shuffled once when the store was written is never shuffled again.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinrank.session import shared_folder

# Ratings that one bucket should hold: few enough to be sorted in memory and read by one task.
RATINGS_PER_BUCKET = 4_000_000


@dataclass(frozen=True)
class HistoryStore:
    """``table`` has the columns of the ratings it was written from."""

    spark: SparkSession
    table: str
    buckets: int

    @classmethod
    def write(cls, ratings: DataFrame, table: str | None = None, buckets: int | None = None) -> HistoryStore:
        """Store ``ratings`` by ``user_id``, in the shared folder unless ``table`` names where.

        Rows are dealt to their buckets before they are written, so that there is one file a bucket. By default
        there are as many buckets as the ratings need, and no fewer than cores. An existing table is
        replaced.
        """
        spark = ratings.sparkSession
        if buckets is None:
            buckets = max(spark.sparkContext.defaultParallelism, math.ceil(ratings.count() / RATINGS_PER_BUCKET))
        name = table or f"histories_{uuid.uuid4().hex}"
        writer = ratings.repartition(buckets, "user_id").write.mode("overwrite").bucketBy(buckets, "user_id").sortBy("user_id")
        if table is None:
            writer = writer.option("path", f"{shared_folder(spark)}/{name}")
        writer.saveAsTable(name, format="parquet")
        return cls(spark, name, buckets)

    def ratings(self) -> DataFrame:
        return self.spark.table(self.table)

    def of_user(self, user_id: int) -> DataFrame:
        """One user's ratings, from one bucket; no rows for somebody unknown."""
        return self.of_users([user_id])

    def of_users(self, user_ids: Iterable[int]) -> DataFrame:
        """The ratings of a handful of users, from their buckets alone."""
        kind = dict(self.ratings().dtypes)["user_id"]
        wanted = [F.lit(user).cast(kind) for user in sorted(set(user_ids))]
        return self.ratings().where(F.col("user_id").isin(wanted) if wanted else F.lit(False))

    def of_targets(self, targets: DataFrame) -> DataFrame:
        """The ratings of a frame of users; only the targets are dealt, not the ratings."""
        kind = dict(self.ratings().dtypes)["user_id"]
        chosen = targets.select(F.col("user_id").cast(kind).alias("user_id")).distinct()
        return self.ratings().join(chosen, "user_id", "left_semi")

    def counts(self) -> DataFrame:
        """``user_id, n_ratings`` of everybody, without an exchange."""
        return self.ratings().groupBy("user_id").agg(F.count("*").alias("n_ratings"))

    def drop(self) -> None:
        """Forget the table; files in the shared folder go with ``release_tables``."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
