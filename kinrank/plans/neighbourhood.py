"""User-neighbourhood recommendation, for all users."""

from __future__ import annotations

from pyspark.sql import functions as F

from kinrank.operators import folds, neighbours, splits
from kinrank.operators.quality import clean_adhoc
from kinrank.operators.topn import with_names
from kinrank.plans.registry import query
from kinrank.plans.sql import MARKS, NEAREST, RATINGS, estimates, ranked, similarities, with_
from kinrank.session import written
from kinrank.sources import tables

_ALL_NEAREST = (RATINGS, similarities("ratings", "ratings"), NEAREST)


def _ratings(spark, folder):
    """Read by several branches of each plan below, so derived from the events once."""
    return written(tables.event_ratings(spark, folder).drop("ts_s"))


@query(
    with_(*_ALL_NEAREST)
    + "SELECT user_id, neighbour_id, n, round(sim, 6) AS sim, CAST(rank AS INTEGER) AS rank FROM near"
)
def user_neighbours(spark, folder):
    near = neighbours.user_neighbours(_ratings(spark, folder))
    return near.withColumn("sim", F.round("sim", 6))


@query(
    with_(*_ALL_NEAREST)
    + "SELECT user_id, neighbour_id, n, round(sim, 6) AS sim, CAST(rank AS INTEGER) AS rank FROM near"
)
def user_neighbours_by_products(spark, folder):
    """The same neighbours from blocks of users who rated the same products."""
    near = neighbours.user_neighbours(_ratings(spark, folder), blocking="products")
    return near.withColumn("sim", F.round("sim", 6))


@query(
    with_(RATINGS, similarities("ratings", "ratings"))
    + """SELECT user_id, neighbour_id, n, round(sim, 6) AS sim FROM sims
WHERE neighbour_id - user_id BETWEEN 1 AND 20"""
)
def user_similarity(spark, folder):
    """Similarity of every user to those with the next twenty ids, whatever its sign."""
    ratings = _ratings(spark, folder)
    steps = F.explode(F.sequence(F.lit(1), F.lit(20)))
    pairs = ratings.select("user_id").distinct().withColumn("_step", steps)
    pairs = pairs.select("user_id", (F.col("user_id") + F.col("_step")).alias("neighbour_id"))
    return neighbours.pair_similarity(ratings, pairs).withColumn("sim", F.round("sim", 6))


@query(
    with_(*_ALL_NEAREST, estimates("ratings"))
    + "SELECT user_id, CAST(product_id AS BIGINT) AS product_id, n, score FROM est"
)
def user_knn_estimates(spark, folder):
    ratings = _ratings(spark, folder)
    return neighbours.knn_estimate(neighbours.user_neighbours(ratings), ratings)


_RECOMMENDED = with_(*_ALL_NEAREST, estimates("ratings"), ranked("ratings"))


@query(
    _RECOMMENDED
    + "SELECT user_id, CAST(pos AS INTEGER) AS pos, CAST(product_id AS BIGINT) AS product_id, score FROM recs"
)
def user_knn_recommend(spark, folder):
    return neighbours.knn_recommend(_ratings(spark, folder))


@query(
    _RECOMMENDED
    + """SELECT user_id, CAST(pos AS INTEGER) AS pos, CAST(product_id AS BIGINT) AS product_id,
       score, p_name AS name
FROM recs LEFT JOIN part ON p_partkey = product_id"""
)
def recommendation_names(spark, folder):
    return with_names(
        neighbours.knn_recommend(_ratings(spark, folder)), tables.part_names(spark, folder)
    )


@query(
    with_(
        RATINGS,
        MARKS,
        "\nmine AS (SELECT * FROM marks WHERE rating BETWEEN 1 AND 5)",
        similarities("mine", "ratings"),
        NEAREST,
        estimates("ratings"),
        ranked("mine"),
    )
    + "SELECT user_id, CAST(pos AS INTEGER) AS pos, CAST(product_id AS BIGINT) AS product_id, score FROM recs"
)
def user_knn_adhoc(spark, folder):
    """People who bring only their signup marks."""
    marks = written(clean_adhoc(tables.signup_marks(spark, folder)))
    return neighbours.knn_recommend(_ratings(spark, folder), target_ratings=marks)


@query(
    with_(
        RATINGS,
        """
hashed AS (SELECT *, (user_id * 7919 + product_id * 104729) % 1009 % 10 AS digit FROM ratings),
train AS (SELECT * FROM hashed WHERE digit < 9),
test AS (SELECT * FROM hashed WHERE digit >= 9)""",
        similarities("train", "train"),
        NEAREST,
        estimates("train"),
    )
    + """SELECT count(*) AS n_test, count(score) AS n_scored,
       count(*) - count(score) AS n_missing, round(avg(abs(score - rating)), 6) AS mae
FROM test LEFT JOIN est ON est.user_id = test.user_id AND est.product_id = test.product_id"""
)
def user_knn_mae(spark, folder):
    return neighbours.knn_mae(_ratings(spark, folder)).withColumn("mae", F.round("mae", 6))


_FOLD_SIMILARITIES = """
folded AS (
  SELECT user_id, product_id, rating,
         (row_number() OVER (ORDER BY ts_s, user_id, product_id) - 1) * 5 // count(*) OVER () + 1 AS fold
  FROM ratings),
folds AS (SELECT DISTINCT fold AS f FROM folded),
sums AS (
  SELECT f, a.user_id, b.user_id AS neighbour_id, count(*) AS n,
         sum(a.rating * 1.0::DOUBLE) AS sx, sum(b.rating * 1.0::DOUBLE) AS sy,
         sum(a.rating * a.rating * 1.0::DOUBLE) AS sxx, sum(b.rating * b.rating * 1.0::DOUBLE) AS syy,
         sum(a.rating * b.rating * 1.0::DOUBLE) AS sxy
  FROM folds JOIN folded AS a ON a.fold <> f
    JOIN folded AS b ON b.fold <> f AND a.product_id = b.product_id AND a.user_id <> b.user_id
  GROUP BY f, a.user_id, b.user_id),
sims AS (
  SELECT f, user_id, neighbour_id, n,
         GREATEST(-1.0::DOUBLE, LEAST(1.0::DOUBLE,
           (n * sxy - sx * sy) / (sqrt(n * sxx - sx * sx) * sqrt(n * syy - sy * sy)))) AS sim
  FROM sums WHERE n * sxx - sx * sx > 0 AND n * syy - sy * sy > 0),
near AS (
  SELECT * FROM (SELECT *, row_number() OVER (
      PARTITION BY f, user_id ORDER BY sim DESC, neighbour_id) AS rank FROM sims) AS s
  WHERE rank <= 25)"""


@query(
    with_(
        RATINGS,
        _FOLD_SIMILARITIES,
        """
bounds AS (SELECT f, min(rating) AS low, max(rating) AS high FROM folds JOIN folded ON fold <> f GROUP BY f),
weighted AS (
  SELECT near.f, near.user_id, t.product_id, count(*) AS n, sum(sim * r.rating) AS num, sum(sim) AS den
  FROM folded AS t JOIN near ON near.f = t.fold AND near.user_id = t.user_id
    JOIN folded AS r ON r.user_id = near.neighbour_id AND r.product_id = t.product_id AND r.fold <> t.fold
  GROUP BY near.f, near.user_id, t.product_id),
est AS (
  SELECT f, user_id, product_id, round(GREATEST(LEAST(num / den, high), low), 6) AS score
  FROM weighted JOIN bounds USING (f) WHERE n >= 2 AND round(den, 9) <> 0)""",
    )
    + """SELECT CAST(t.fold AS INTEGER) AS fold, count(*) AS n_test, count(score) AS n_scored,
       round(avg(abs(score - rating)), 6) AS mae
FROM folded AS t LEFT JOIN est ON est.f = t.fold AND est.user_id = t.user_id AND est.product_id = t.product_id
GROUP BY t.fold"""
)
def user_knn_fold_errors(spark, folder):
    """The error of each of five folds in the order of time, from one set of cells."""
    folded = written(splits.split_kfold(written(tables.event_ratings(spark, folder)), 5).drop("ts_s"))
    return folds.knn_fold_errors(folded, 5).withColumn("mae", F.round("mae", 6))
