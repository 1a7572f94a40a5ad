"""Validation, summaries and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from kinrank.operators import quality, splits
from kinrank.operators.topn import candidate_counts
from kinrank.plans.registry import query
from kinrank.plans.sql import DAILY_MARKS, MARKS, RATINGS, with_
from kinrank.sources import tables
from kinrank.sources.histories import HistoryStore


@query(
    """WITH scores AS (
  SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS product_id,
         CAST(floor(value / 25) AS INTEGER) - 1 AS rating FROM events)
SELECT event_id, user_id, product_id, rating,
       CASE WHEN rating < 0 THEN 'below range' WHEN rating > 5 THEN 'above range'
            ELSE 'unknown product' END AS reason
FROM scores LEFT JOIN nation ON n_nationkey = product_id
WHERE rating < 0 OR rating > 5 OR n_nationkey IS NULL"""
)
def invalid_ratings(spark, folder):
    return quality.invalid_ratings(
        tables.raw_event_scores(spark, folder), tables.nation_names(spark, folder)
    )


@query(with_(MARKS) + "SELECT user_id, product_id, rating FROM marks WHERE rating BETWEEN 1 AND 5")
def adhoc_ratings_clean(spark, folder):
    return quality.clean_adhoc(tables.signup_marks(spark, folder))


@query(
    with_(DAILY_MARKS)
    + "SELECT user_id FROM daily_marks GROUP BY user_id HAVING max(rating) < 1"
)
def adhoc_users_empty(spark, folder):
    """People, one for each day a user signed up on, who left only "not seen" marks."""
    return quality.adhoc_users_without_ratings(tables.signup_marks(spark, folder, daily=True))


@query(
    with_(RATINGS)
    + """SELECT c_custkey AS user_id FROM customer
WHERE c_custkey NOT IN (SELECT user_id FROM ratings)"""
)
def unknown_users(spark, folder):
    """Customers who rated nothing."""
    targets = tables.table(spark, folder, "customer").select(F.col("c_custkey").alias("user_id"))
    return quality.unknown_users(targets, tables.event_ratings(spark, folder))


@query(
    with_(RATINGS)
    + """SELECT user_id, count(*) AS n_ratings FROM ratings
GROUP BY user_id HAVING count(*) < 50"""
)
def users_below_min_ratings(spark, folder):
    return quality.users_below(tables.event_ratings(spark, folder), 50)


@query(
    with_(RATINGS)
    + """SELECT count(*) AS n_ratings, count(DISTINCT user_id) AS n_users,
       count(DISTINCT product_id) AS n_products FROM ratings"""
)
def ratings_summary(spark, folder):
    return quality.ratings_summary(tables.event_ratings(spark, folder))


@query(
    with_(RATINGS)
    + """SELECT user_id, CAST(product_id // 25 AS BIGINT) AS chunk, count(*) AS n_ratings,
       string_agg(product_id || ':' || rating, ' ' ORDER BY product_id) AS history
FROM ratings GROUP BY user_id, product_id // 25"""
)
def user_histories(spark, folder):
    entry = F.transform(
        "history",
        lambda h: F.concat_ws(":", h["product_id"].cast("string"), h["rating"].cast("string")),
    )
    histories = quality.user_histories(tables.event_ratings(spark, folder), span=25)
    return histories.withColumn("history", F.array_join(entry, " "))


@query(
    with_(RATINGS)
    + """SELECT user_id, product_id, rating, ts_s FROM ratings
WHERE user_id IN (SELECT s_suppkey FROM supplier)"""
)
def user_lookup(spark, folder):
    """The ratings of users who are suppliers, too."""
    targets = tables.table(spark, folder, "supplier").select(F.col("s_suppkey").alias("user_id"))
    return quality.ratings_of(tables.event_ratings(spark, folder), targets)


@query(
    with_(RATINGS, MARKS)
    + """SELECT user_id, product_id, rating FROM ratings
UNION ALL SELECT user_id, product_id, rating FROM marks WHERE rating BETWEEN 1 AND 5"""
)
def ratings_with_adhoc(spark, folder):
    return quality.with_adhoc(
        tables.event_ratings(spark, folder),
        quality.clean_adhoc(tables.signup_marks(spark, folder)),
    )


@query(
    with_(RATINGS)
    + """SELECT c_custkey AS user_id, count(r.product_id) AS n_rated,
       (SELECT count(*) FROM part) - count(r.product_id) AS n_candidates
FROM customer LEFT JOIN (
  SELECT user_id, product_id FROM ratings JOIN part ON p_partkey = product_id) AS r
  ON r.user_id = c_custkey
GROUP BY c_custkey"""
)
def candidates_unrated(spark, folder):
    targets = tables.table(spark, folder, "customer").select(F.col("c_custkey").alias("user_id"))
    return candidate_counts(
        targets, tables.part_names(spark, folder), tables.event_ratings(spark, folder)
    )


@query(
    with_(RATINGS)
    + """, labelled AS (
  SELECT *, CASE WHEN ts_s % 10 <= 3 THEN 'train' WHEN ts_s % 10 = 4 THEN 'valid'
     WHEN ts_s % 10 = 5 THEN 'test' ELSE 'unused' END AS split FROM ratings)
SELECT coalesce(split, 'all') AS split, count(*) AS n_ratings, count(DISTINCT user_id) AS n_users,
  count(DISTINCT product_id) AS n_products
FROM labelled GROUP BY GROUPING SETS ((split), ())"""
)
def split_summaries(spark, folder):
    """Ratings, users and products of each part and of all, from the same bitmaps."""
    split = splits.split_ts_digit(tables.event_ratings(spark, folder))
    split = split.withColumn("split", F.coalesce("split", F.lit("unused")))
    return quality.split_summaries(split).withColumn("split", F.coalesce("split", F.lit("all")))


def _store(spark, folder):
    return HistoryStore.write(tables.event_ratings(spark, folder), buckets=16)


@query(
    with_(RATINGS)
    + "SELECT user_id, product_id, rating, ts_s FROM ratings WHERE user_id IN (1, 7, 19, 40, 99999999)"
)
def history_of_users(spark, folder):
    """The ratings of a handful of users, from their buckets alone."""
    return _store(spark, folder).of_users([1, 7, 19, 40, 99_999_999])


@query(
    with_(RATINGS)
    + """SELECT user_id, product_id, rating, ts_s FROM ratings
WHERE user_id IN (SELECT user_id FROM events WHERE event_type = 'signup')"""
)
def histories_of_targets(spark, folder):
    """The ratings of everybody who signed up, joined bucket by bucket."""
    signed_up = tables.table(spark, folder, "events").where("event_type = 'signup'").select("user_id")
    return _store(spark, folder).of_targets(signed_up)


@query(with_(RATINGS) + "SELECT user_id, count(*) AS n_ratings FROM ratings GROUP BY user_id")
def history_counts(spark, folder):
    return _store(spark, folder).counts()
