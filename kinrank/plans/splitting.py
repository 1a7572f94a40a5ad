"""Training and held-out rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from kinrank.operators import splits
from kinrank.plans.registry import query
from kinrank.plans.sql import HASHED, RATINGS, with_
from kinrank.session import written
from kinrank.sources import tables

_DIGIT = """CASE WHEN ts_s % 10 <= 3 THEN 'train' WHEN ts_s % 10 = 4 THEN 'valid'
     WHEN ts_s % 10 = 5 THEN 'test' ELSE 'unused' END AS split"""


def _by_digit(spark, folder):
    split = splits.split_ts_digit(tables.event_ratings(spark, folder))
    return split.withColumn("split", F.coalesce("split", F.lit("unused")))


@query(with_(RATINGS) + f"SELECT user_id, product_id, rating, ts_s, {_DIGIT} FROM ratings")
def split_ts_digit(spark, folder):
    return _by_digit(spark, folder)


@query(with_(RATINGS) + f"SELECT {_DIGIT}, count(*) AS n_rows FROM ratings GROUP BY split")
def split_sizes(spark, folder):
    return splits.split_sizes(_by_digit(spark, folder))


@query(
    with_(RATINGS, HASHED)
    + """SELECT user_id, product_id, rating, ts_s,
       CASE WHEN digit < 8 THEN 'train' ELSE 'test' END AS split FROM hashed"""
)
def split_random(spark, folder):
    return splits.split_hash(tables.event_ratings(spark, folder), 8)


_ORDINALS = """
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts_s, product_id) AS ordinal
  FROM ratings),
held AS (
  SELECT *, row_number() OVER (ORDER BY ts_s, user_id, product_id) AS place
  FROM numbered WHERE ordinal BETWEEN {start} AND {stop})
SELECT r.user_id, r.product_id, r.rating, r.ts_s,
       CASE WHEN h.place <= {cap} THEN 'test' ELSE 'train' END AS split
FROM ratings AS r LEFT JOIN held AS h
  ON h.user_id = r.user_id AND h.product_id = r.product_id"""


@query(with_(RATINGS, _ORDINALS.format(start=1, stop=10, cap=1_000_000_000)))
def split_leave_n_out(spark, folder):
    """Each user's first ten ratings are held out."""
    return splits.split_ordinals(tables.event_ratings(spark, folder), 1, 10)


@query(with_(RATINGS, _ORDINALS.format(start=11, stop=20, cap=1000)))
def split_leave_n_out_capped(spark, folder):
    """Each user's next ten ratings are held out, 1000 rows at most."""
    return splits.split_ordinals(written(tables.event_ratings(spark, folder)), 11, 20, cap=1000)


@query(
    with_(RATINGS)
    + """SELECT user_id, product_id, rating, ts_s,
       CAST((row_number() OVER (ORDER BY ts_s, user_id, product_id) - 1) * 5
            // count(*) OVER () + 1 AS INTEGER) AS fold
FROM ratings"""
)
def split_kfold(spark, folder):
    # read a few times, so derived from the events once
    return splits.split_kfold(written(tables.event_ratings(spark, folder)), 5)
