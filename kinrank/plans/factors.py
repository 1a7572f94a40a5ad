"""Latent-factor recommendation.

Fitting is iterative, so SQL can't give the scores. What it can give are the rows and the
properties that a right fit has by definition: that each user's factors solve their normal
equations, that a prediction is the product of its factors, and how many products of what
kind are recommended. Queries for those compare measured properties with SQL.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F

from kinrank.functions.scores import block_of
from kinrank.operators import als, fold_in, norm_search, splits
from kinrank.operators.blocks import cell_partitions
from kinrank.operators.evaluate import least_error, rmse_of_predicted
from kinrank.operators.quality import adhoc_with_ratings, clean_adhoc
from kinrank.plans.registry import query
from kinrank.plans.sql import MARKS, RATINGS, with_
from kinrank.session import written
from kinrank.sources import tables

# Parameters of the demonstration model.
MODEL = {"rank": 12, "regularisation": 0.1, "iterations": 10}


def _parts(spark, folder):
    """Training and held-out supplier ratings."""
    split = written(splits.split_hash(tables.order_ratings(spark, folder)))
    return [split.where(F.col("split") == part) for part in (splits.TRAIN, splits.TEST)]


@query()
def als_predict(spark, folder):
    """Held-out supplier ratings with their predictions."""
    train, test = _parts(spark, folder)
    return als.als_predict(als.als_fit(train, **MODEL), test.drop("split"))


@query(
    """WITH supplied AS (
  SELECT CAST(o_custkey AS INTEGER) AS user_id, CAST(l_suppkey AS INTEGER) AS product_id,
         CAST(1 + floor((avg(l_quantity) - 1) / 10) AS INTEGER) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, l_suppkey),
hashed AS (
  SELECT *, (CAST(user_id AS BIGINT) * 7919 + product_id * 104729) % 1009 % 10 AS digit
  FROM supplied),
train AS (SELECT * FROM hashed WHERE digit < 8)
SELECT user_id, product_id, rating FROM hashed
WHERE digit >= 8 AND user_id IN (SELECT user_id FROM train)
  AND product_id IN (SELECT product_id FROM train)"""
)
def als_predicted_pairs(spark, folder):
    """The held-out ratings that get a prediction: user and product are known."""
    return als_predict(spark, folder).drop("prediction")


@query()
def als_rmse(spark, folder):
    train, test = _parts(spark, folder)
    return rmse_of_predicted(als.als_predict(als.als_fit(train, **MODEL), test), test)


@query()
def als_implicit_rmse(spark, folder):
    split = written(splits.split_hash(tables.order_ratings(spark, folder)))
    return als.als_implicit_rmse(split, rank=10, iterations=10, regularisation=1.0)


def _recommend(spark, folder, n, exclude_rated):
    """Recommendations, and the ratings and names they are from."""
    ratings = written(tables.order_ratings(spark, folder))
    model = als.als_fit(ratings, **MODEL)
    names = tables.supplier_names(spark, folder)
    return als.als_recommend(model, ratings, names, n=n, exclude_rated=exclude_rated), ratings, names


@query()
def als_recommend_user(spark, folder):
    """Ten unrated suppliers for every customer."""
    return _recommend(spark, folder, 10, True)[0]


@query()
def als_topk_with_rated(spark, folder):
    """Thirty suppliers for every customer, rated or not."""
    return _recommend(spark, folder, 30, False)[0]


@query(
    with_(RATINGS)
    + """SELECT CAST(user_id AS INTEGER) AS user_id, product_id FROM (
  SELECT user_id, product_id
  FROM (SELECT DISTINCT user_id FROM ratings) AS u, (SELECT DISTINCT product_id FROM ratings) AS p
  WHERE product_id IN (SELECT p_partkey FROM part)
  EXCEPT SELECT user_id, product_id FROM ratings) AS unrated"""
)
def als_unrated_pairs(spark, folder):
    """As many products for every user as the catalogue has: all that are unrated."""
    ratings = written(tables.event_ratings(spark, folder))
    model = als.als_fit(ratings, **MODEL)
    names = tables.part_names(spark, folder)
    recommended = als.als_recommend(model, ratings, names, n=max(1, names.count()))
    return recommended.select("user_id", "product_id")


# Products of a band: small, so that the catalogues of the test tables have many.
BAND = 16


def _best(spark, folder, n, exclude_rated):
    """Is there any better product than those the bounded search returns?"""
    ratings = written(tables.event_ratings(spark, folder))
    model, names = als.als_fit(ratings, **MODEL), tables.part_names(spark, folder)
    found = written(
        norm_search.bounded_recommend(model, ratings, names, n=n, exclude_rated=exclude_rated, band_products=BAND)
    )
    rated = ratings if exclude_rated else ratings.where(F.lit(False))
    return norm_search.best_possible(model, names, found, rated, n)


def _best_possible(limit: int, rated_too: bool) -> str:
    left = "" if rated_too else " - count(*) FILTER (WHERE product_id IN (SELECT p_partkey FROM part))"
    return (
        with_(RATINGS)
        + f""", offered AS (
  SELECT count(DISTINCT product_id) AS n FROM ratings WHERE product_id IN (SELECT p_partkey FROM part))
SELECT CAST(user_id AS INTEGER) AS user_id, least({limit}, any_value(n){left}) AS n_recommended,
  0::BIGINT AS n_above, 0::BIGINT AS n_missing
FROM ratings, offered GROUP BY user_id"""
    )


@query(_best_possible(10, False))
def als_recommend_best(spark, folder):
    """Nobody has an unrated product that scores above the last of their ten."""
    return _best(spark, folder, 10, True)


@query(_best_possible(30, True))
def als_topk_best(spark, folder):
    """Nobody has a product, rated or not, that scores above the last of their thirty."""
    return _best(spark, folder, 30, False)


@query(with_(RATINGS) + "SELECT CAST(user_id AS INTEGER) AS user_id, true AS adds_up FROM ratings GROUP BY user_id")
def als_search_work(spark, folder):
    """For every user, products scored and products skipped add up to the catalogue."""
    ratings = written(tables.event_ratings(spark, folder))
    model, names = als.als_fit(ratings, **MODEL), tables.part_names(spark, folder)
    found = norm_search.search_products(model, ratings, names, band_products=BAND)
    work = norm_search.search_work(found, names, model)
    known = norm_search.known_catalogue(model, names).agg(F.count("*")).scalar()
    right = (F.col("scored") + F.col("skipped") == known) & (F.col("scored") > 0) & (F.col("skipped") >= 0)
    return work.select("user_id", right.alias("adds_up"))


@query()
def als_recommend_adhoc(spark, folder):
    """Ten products for everybody who left marks at signup; nobody is asked of whom all marks are "not seen"."""
    return als.als_recommend_adhoc(
        tables.event_ratings(spark, folder),
        adhoc_with_ratings(written(tables.signup_marks(spark, folder))),
        tables.part_names(spark, folder),
        **MODEL,
    )


@query()
def als_grid_search(spark, folder):
    split = written(splits.split_ts_digit(tables.event_ratings(spark, folder)))
    train, valid, test = (
        split.where(F.col("split") == part) for part in (splits.TRAIN, splits.VALID, splits.TEST)
    )
    return als.als_grid(train, valid, test)


# A component of the normal equations' residual, relative to the sum of its terms.
TOLERANCE = 1e-3

# Ratings of a block of users, and those that a task looks at together.
BLOCK_RATINGS = 4_000_000
AT_ONCE = 1 << 18

SUPPLIED = """
supplied AS (
  SELECT CAST(o_custkey AS INTEGER) AS user_id, CAST(l_suppkey AS INTEGER) AS product_id,
         CAST(1 + floor((avg(l_quantity) - 1) / 10) AS INTEGER) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, l_suppkey)"""


def _dot(a: str, b: str):
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def _solved_cell(rank, regularisation, gram, output):
    """The check of a block of users, from their ratings and the factors of them and of what they rated."""

    def by_id(factors: pa.Table):
        factors = factors.sort_by("id")
        flat = factors["features"].combine_chunks().flatten().to_numpy()
        return factors["id"].to_numpy(), flat.reshape(-1, rank).astype(np.float64)

    def positions(ids, wanted):
        place = np.minimum(np.searchsorted(ids, wanted), len(ids) - 1)
        return place, ids[place] == wanted

    def solved(factors: pa.Table, rated: pa.Table) -> pa.Table:
        users, u = by_id(factors.filter(factors["is_user"]))
        products, v = by_id(factors.filter(pc.invert(factors["is_user"])))
        if not len(users) or not len(products):
            return output.empty_table()
        residual, scale = np.zeros((2, rank, len(users)))
        n_ratings, n = np.zeros(len(users), dtype=np.int64), np.zeros(len(users))
        for first in range(0, len(rated), AT_ONCE):
            some = rated.slice(first, AT_ONCE)
            who, known_user = positions(users, some["user_id"].to_numpy())
            what, known_product = positions(products, some["product_id"].to_numpy())
            known = known_user & known_product
            who, what = who[known], what[known]
            weight, target, counted = (some[name].to_numpy()[known] for name in ("weight", "target", "counted"))
            own, reached = v[what], weight * (u[who] * v[what]).sum(axis=1)
            for d in range(rank):
                residual[d] += np.bincount(who, own[:, d] * (reached - target), len(users))
                scale[d] += np.bincount(who, np.abs(own[:, d]) * (np.abs(reached) + np.abs(target)), len(users))
            n_ratings += np.bincount(who, minlength=len(users))
            n += np.bincount(who, counted, len(users))
        shrunk = regularisation * n * u.T
        residual, scale = residual + shrunk, scale + np.abs(shrunk)
        if gram is not None:
            residual, scale = residual + gram @ u.T, scale + np.abs(gram) @ np.abs(u.T)
        holds, seen = (np.abs(residual) <= TOLERANCE * scale).all(axis=0), n_ratings > 0
        return pa.table([pa.array(column[seen]) for column in (users, n_ratings, holds)], names=output.names).cast(output)

    return solved


def _solved(model, ratings, regularisation, weight, target, counted, gram=None):
    """Whether each user's factors u solve ``(reg * n + gram + sum w v v') u = sum t v``.

    The residual must vanish beside the terms it is made of. ``gram`` is the product of all
    product factors with themselves, in implicit fits. Users are hashed into blocks. A block gets
    the ratings of its users, and the factors of a product once however many of them rated it.
    """
    n_ratings, cores = ratings.count(), ratings.sparkSession.sparkContext.defaultParallelism
    blocks = max(2 * cores, math.ceil(n_ratings / BLOCK_RATINGS))
    ratings = ratings.withColumn("block", block_of(F.col("user_id"), blocks))
    products = model.itemFactors.select(F.col("id").alias("product_id"), "features")
    factors = model.userFactors.select(
        block_of(F.col("id"), blocks).alias("block"), F.lit(True).alias("is_user"), "id", "features"
    ).unionByName(
        ratings.select("block", "product_id").distinct().join(products, "product_id").select(
            "block", F.lit(False).alias("is_user"), F.col("product_id").cast("int").alias("id"), "features"
        )
    )
    partitions = cell_partitions(ratings, blocks, 32.0 * n_ratings)
    numbers = {"weight": weight, "target": target, "counted": counted}
    rated = ratings.repartition(partitions, "block").select(
        "block", "user_id", "product_id", *[column.cast("double").alias(name) for name, column in numbers.items()]
    )
    wide = dict(ratings.dtypes)["user_id"] == "bigint"
    output = pa.schema([("user_id", pa.int64() if wide else pa.int32()), ("n_ratings", pa.int64()), ("solved", pa.bool_())])
    return (
        factors.repartition(partitions, "block")
        .groupBy("block")
        .cogroup(rated.groupBy("block"))
        .applyInArrow(
            _solved_cell(model.rank, regularisation, None if gram is None else np.array(gram), output),
            f"user_id {'bigint' if wide else 'int'}, n_ratings bigint, solved boolean",
        )
    )


_EVERY_USER = "SELECT user_id, count(*) AS n_ratings, true AS solved FROM supplied GROUP BY user_id"


@query(with_(SUPPLIED) + _EVERY_USER)
def als_normal_equations(spark, folder):
    """Explicit fit: every customer's factors solve their least squares."""
    ratings = written(tables.order_ratings(spark, folder))
    model = als.als_fit(ratings, **MODEL)
    rating = F.col("rating").cast("double")
    return _solved(model, ratings, MODEL["regularisation"], F.lit(1.0), rating, F.lit(1))


@query(with_(SUPPLIED) + _EVERY_USER)
def als_implicit_normal_equations(spark, folder):
    """Implicit fit on signed confidences: the weighted equations hold for every customer."""
    shifted = F.col("rating").cast("double") - 2.5
    ratings = written(tables.order_ratings(spark, folder).withColumn("rating", shifted))
    rank, regularisation = 10, 1.0
    model = als.als_fit(ratings, rank, 10, regularisation, implicit=True)
    v = F.col("features")
    cells = [F.sum(v[d].cast("double") * v[e]).alias(f"c{d}_{e}") for d in range(rank) for e in range(rank)]
    found = list(model.itemFactors.agg(*cells).first())
    gram = [found[d * rank : (d + 1) * rank] for d in range(rank)]
    liked = F.col("rating") > 0
    target = F.when(liked, 1 + F.abs("rating")).otherwise(0.0)
    return _solved(model, ratings, regularisation, F.abs("rating"), target, liked, gram)


@query(
    with_(SUPPLIED)
    + """, hashed AS (
  SELECT *, (CAST(user_id AS BIGINT) * 7919 + product_id * 104729) % 1009 % 10 AS digit
  FROM supplied),
train AS (SELECT * FROM hashed WHERE digit < 8)
SELECT user_id, product_id, rating, true AS is_product FROM hashed
WHERE digit >= 8 AND user_id IN (SELECT user_id FROM train)
  AND product_id IN (SELECT product_id FROM train)"""
)
def als_predictions_are_products(spark, folder):
    """Each held-out prediction beside the product of its factors."""
    train, test = _parts(spark, folder)
    model = als.als_fit(train, **MODEL)
    users = model.userFactors.select(F.col("id").alias("user_id"), F.col("features").alias("u"))
    products = model.itemFactors.select(F.col("id").alias("product_id"), F.col("features").alias("v"))
    rows = als.als_predict(model, test.drop("split")).join(users, "user_id").join(products, "product_id")
    error = F.abs(F.col("prediction") - _dot("u", "v"))
    return rows.select("user_id", "product_id", "rating", (error < 1e-4).alias("is_product"))


def _described(recommended, rated, names):
    """Of each user's recommendations: how many, how many rated or without a name, and
    whether scores descend by position from 1 on without a gap."""
    known = rated.select(F.col("user_id").cast("int").alias("user_id"), F.col("product_id").cast("int").alias("product_id"))
    named = names.select(F.col("product_id").cast("int").alias("product_id")).distinct()
    before = F.lag(F.struct("pos", "score")).over(Window.partitionBy("user_id").orderBy("pos"))
    marked = (
        recommended.withColumn("_before", before)
        .join(known.withColumn("_rated", F.lit(1)), ["user_id", "product_id"], "left")
        .join(named.withColumn("_named", F.lit(1)), "product_id", "left")
    )
    follows = (F.col("_before.pos") + 1 == F.col("pos")) & (F.col("score") <= F.col("_before.score"))
    in_order = F.when(F.col("pos") == 1, F.col("_before").isNull()).otherwise(F.coalesce(follows, F.lit(False)))
    return marked.groupBy("user_id").agg(
        F.count("*").alias("n_recommended"),
        F.countDistinct("product_id").alias("n_products"),
        F.count("_rated").alias("n_rated"),
        (F.count("*") - F.count("_named")).alias("n_nameless"),
        F.bool_and(in_order).alias("descends"),
    )


def _expected(limit: int, rated_too: bool) -> str:
    left = "" if rated_too else " - count(*) FILTER (WHERE product_id IN (SELECT s_suppkey FROM supplier))"
    return (
        with_(SUPPLIED)
        + f""", offered AS (
  SELECT count(DISTINCT product_id) AS n FROM supplied WHERE product_id IN (SELECT s_suppkey FROM supplier)),
each_user AS (
  SELECT user_id, least({limit}, any_value(n){left}) AS n_recommended
  FROM supplied, offered GROUP BY user_id)
SELECT user_id, n_recommended, n_recommended AS n_products, 0::BIGINT AS n_rated,
  0::BIGINT AS n_nameless, true AS descends FROM each_user WHERE n_recommended > 0"""
    )


@query(_expected(10, False))
def als_recommend_described(spark, folder):
    """Ten unrated suppliers for every customer, in order."""
    return _described(*_recommend(spark, folder, 10, True))


@query(_expected(30, True))
def als_topk_described(spark, folder):
    """Thirty suppliers for every customer, rated ones not held back."""
    recommended, ratings, names = _recommend(spark, folder, 30, False)
    return _described(recommended, ratings.where(F.lit(False)), names)


@query(
    with_(RATINGS, MARKS)
    + """, mine AS (SELECT user_id, product_id FROM marks WHERE rating BETWEEN 1 AND 5),
offered AS (
  SELECT DISTINCT product_id FROM (SELECT product_id FROM ratings UNION ALL SELECT product_id FROM mine)
  WHERE product_id IN (SELECT p_partkey FROM part)),
each_user AS (
  SELECT user_id, least(10, (SELECT count(*) FROM offered)
    - count(*) FILTER (WHERE product_id IN (SELECT product_id FROM offered))) AS n_recommended
  FROM mine GROUP BY user_id)
SELECT CAST(user_id AS INTEGER) AS user_id, n_recommended, n_recommended AS n_products,
  0::BIGINT AS n_rated, 0::BIGINT AS n_nameless, true AS descends
FROM each_user WHERE n_recommended > 0"""
)
def als_adhoc_described(spark, folder):
    """Ten products for everybody who left marks at signup, none of those they marked."""
    marks = tables.signup_marks(spark, folder).where("rating > 0")
    return _described(als_recommend_adhoc(spark, folder), marks, tables.part_names(spark, folder))


@query()
def als_rmse_scored(spark, folder):
    """Error of the explicit fit over the held-out rows that have a prediction."""
    train, test = _parts(spark, folder)
    return rmse_of_predicted(als.als_predict(als.als_fit(train, **MODEL), test))


_MINE = """, mine AS (SELECT user_id, product_id FROM marks WHERE rating BETWEEN 1 AND 5),
offered AS (SELECT DISTINCT product_id FROM ratings)"""


def _folded(spark, folder):
    """A model of the events' users, and people with signup marks folded into it."""
    model = als.als_fit(written(tables.event_ratings(spark, folder)), **MODEL)
    marks = written(clean_adhoc(tables.signup_marks(spark, folder)))
    return model, marks, fold_in.fold_in(model, marks, MODEL["regularisation"])


@query(
    with_(RATINGS, MARKS)
    + _MINE
    + """
SELECT user_id, count(*) AS n_ratings, true AS solved
FROM mine WHERE product_id IN (SELECT product_id FROM offered) GROUP BY user_id"""
)
def als_fold_in_equations(spark, folder):
    """Everybody's folded-in factors solve their own least squares over the fixed products."""
    _, marks, folded = _folded(spark, folder)
    rating = F.col("rating").cast("double")
    return _solved(folded, marks, MODEL["regularisation"], F.lit(1.0), rating, F.lit(1))


@query(
    with_(RATINGS, MARKS)
    + _MINE
    + """, catalogue AS (SELECT product_id FROM offered WHERE product_id IN (SELECT p_partkey FROM part))
SELECT CAST(user_id AS INTEGER) AS user_id,
  least(10, (SELECT count(*) FROM catalogue)
    - count(*) FILTER (WHERE product_id IN (SELECT product_id FROM catalogue))) AS n_recommended,
  0::BIGINT AS n_above, 0::BIGINT AS n_missing
FROM mine GROUP BY user_id HAVING bool_or(product_id IN (SELECT product_id FROM offered))"""
)
def als_fold_in_best(spark, folder):
    """Ten products for everybody who left marks, from a model fitted without them: none is better."""
    model, marks, folded = _folded(spark, folder)
    names = tables.part_names(spark, folder)
    found = written(fold_in.recommend_folded(model, marks, names, MODEL["regularisation"], band_products=BAND))
    return norm_search.best_possible(folded, names, found, marks, 10)


def _held_out_with_products(model, test):
    """Held-out ratings with the product of their factors, computed here."""
    users = model.userFactors.select(F.col("id").alias("user_id"), F.col("features").alias("u"))
    products = model.itemFactors.select(F.col("id").alias("product_id"), F.col("features").alias("v"))
    return test.join(users, "user_id").join(products, "product_id").withColumn("product", _dot("u", "v"))


def _error_agrees(found, model, test, n):
    """Whether an error is that of the products of factors over ``n`` rows."""
    again = _held_out_with_products(model, test).agg(F.sum(F.pow(F.col("product") - F.col("rating"), F.lit(2)))).scalar()
    return found.select("n", (F.abs(F.col("rmse") - F.sqrt(again / n)) < 1e-5).alias("agrees"))


_HELD_OUT = (
    with_(SUPPLIED)
    + """, hashed AS (
  SELECT *, (CAST(user_id AS BIGINT) * 7919 + product_id * 104729) % 1009 % 10 AS digit
  FROM supplied),
train AS (SELECT * FROM hashed WHERE digit < 8)
SELECT count(*) AS n, true AS agrees FROM hashed WHERE digit >= 8"""
)
_KNOWN = """ AND user_id IN (SELECT user_id FROM train) AND product_id IN (SELECT product_id FROM train)"""


@query(_HELD_OUT)
def als_rmse_agrees(spark, folder):
    """The error over all held-out rows, beside that of the products of factors."""
    train, test = _parts(spark, folder)
    model = als.als_fit(train, **MODEL)
    found = rmse_of_predicted(als.als_predict(model, test), test)
    return _error_agrees(found, model, test, F.col("n"))


@query(_HELD_OUT + _KNOWN)
def als_rmse_scored_agrees(spark, folder):
    """The error over the held-out rows with a prediction, beside that of the products."""
    train, test = _parts(spark, folder)
    model = als.als_fit(train, **MODEL)
    return _error_agrees(rmse_of_predicted(als.als_predict(model, test)), model, test, F.col("n"))


@query(
    """SELECT rank::INTEGER AS rank, reg::DOUBLE AS reg, iters::INTEGER AS iters, true AS agrees,
  true AS chosen_rightly, 4::BIGINT AS n_trials
FROM (VALUES (4), (8)) AS r(rank), (VALUES (0.1), (10.0)) AS g(reg), (VALUES (5)) AS i(iters)"""
)
def als_grid_checked(spark, folder):
    """Four fits at the same time: each error is that of the products of its factors, and the row that
    the grid chooses is the first of the least."""
    split = written(splits.split_ts_digit(tables.event_ratings(spark, folder)))
    train, valid, test = (
        split.where(F.col("split") == part).select("user_id", "product_id", "rating")
        for part in (splits.TRAIN, splits.VALID, splits.TEST)
    )
    points = {"ranks": (4, 8), "regularisations": (0.1, 10.0), "iterations": (5,)}
    n_valid = valid.count()
    again = []
    for trial in als.als_trials(train, valid, **points):
        squares = _held_out_with_products(trial.model, valid).agg(F.sum(F.pow(F.col("product") - F.col("rating"), F.lit(2))))
        again.append((trial.rank, trial.reg, trial.iters, trial.place, math.sqrt(squares.first()[0] / n_valid)))
    recomputed = spark.createDataFrame(again, "rank int, reg double, iters int, trial int, product_rmse double")
    least = least_error(recomputed.withColumnRenamed("product_rmse", "rmse_valid")).select(
        "rank", "reg", "iters", "rmse_valid", F.col("is_best").alias("is_least")
    ).withColumnRenamed("rmse_valid", "product_rmse")
    found = als.als_grid(train, valid, test, **points)
    n_trials = found.agg(F.count("*")).scalar()
    return found.join(least, ["rank", "reg", "iters"]).select(
        "rank",
        "reg",
        "iters",
        (F.abs(F.col("rmse_valid") - F.col("product_rmse")) < 1e-3).alias("agrees"),
        ((F.col("is_best") == F.col("is_least")) & (F.col("rmse_test").isNotNull() == F.col("is_best"))).alias("chosen_rightly"),
        n_trials.alias("n_trials"),
    )
