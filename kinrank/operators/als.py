"""Latent-factor recommendation with Spark's alternating least squares."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor, as_completed
from dataclasses import dataclass
from itertools import product as grid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from kinrank.functions.scores import binary_label, block_of, implicit_shift
from kinrank.operators.blocks import Side, best_per_row, block_count, cell_partitions
from kinrank.operators.evaluate import rmse_of_predicted
from kinrank.operators.norm_search import CELL_ROWS, bounded_recommend
from kinrank.operators.quality import ratings_of, require_adhoc, with_adhoc
from kinrank.operators.splits import TEST, TRAIN
from kinrank.operators.topn import top_n
from kinrank.session import ensure_checkpoint_dir, forget, written

# Default training parameters.
RANK = 10
ITERATIONS = 20
REGULARISATION = 1.0
SEED = 42

# Combinations of a grid that are fitted at the same time.
TRIALS_AT_ONCE = 4

# Ratings of a fit that a core should hold in a block, about 40 bytes each while it is built. In every
# iteration a user's factors go to each product block with one of their ratings, and the other way round:
# the more blocks there are, the more copies are shuffled.
RATINGS_PER_BLOCK = 18_000_000
# Bytes of a rating in the three shuffles that make the blocks.
RATING_BYTES = 36

# Large blocks keep the copies of the factors few; tiles keep the arrays of a task small.
BLOCK_USERS = 65_536
BLOCK_PRODUCTS = 8192
BLOCK_RATINGS = 4_000_000
TILE_SCORES = 4_000_000

OUTPUT = pa.schema([("user_id", pa.int32()), ("product_id", pa.int32()), ("score", pa.float64())])


def _training(ratings: DataFrame) -> DataFrame:
    """Ratings in the types factors are fitted from; an id beyond INT fails."""
    return ratings.select(
        F.col("user_id").cast("int").alias("user_id"),
        F.col("product_id").cast("int").alias("product_id"),
        F.col("rating").cast("float").alias("rating"),
    )


def _blocks(ratings: DataFrame, rank: int, iterations: int) -> tuple[int, int]:
    """User and product blocks of a fit: as many as cores, and more where the ratings need them.

    The side whose blocks get more bytes of factors, over all iterations, than the ratings themselves
    weigh has half as many blocks as cores. Then half of the cores work on twice as large blocks, so that an
    executor holds no more ratings at a time than with a block on every core.
    """
    cores = max(2, ratings.sparkSession.sparkContext.defaultParallelism)
    n_ratings = ratings.count()
    if n_ratings > cores * RATINGS_PER_BLOCK:
        blocks = math.ceil(n_ratings / RATINGS_PER_BLOCK)
        return blocks, blocks
    users, products = ratings.agg(*[F.approx_count_distinct(c) for c in ("user_id", "product_id")]).first()
    fewer = max(2, cores // 2)

    def blocks_for(others: int) -> int:
        # somebody goes to no more blocks than they have ratings
        spared = min(others * cores, n_ratings) - min(others * fewer, n_ratings)
        return fewer if 4 * (rank + 1) * iterations * spared > RATING_BYTES * n_ratings else cores

    return blocks_for(products), blocks_for(users)


def als_fit(
    ratings: DataFrame,
    rank: int = RANK,
    iterations: int = ITERATIONS,
    regularisation: float = REGULARISATION,
    implicit: bool = False,
    user_blocks: int | None = None,
    product_blocks: int | None = None,
    seed: int = SEED,
) -> ALSModel:
    """Fit user and product factors. Ids must be within the range of INT.

    By default there are as many user and product blocks as the ratings need, and as cores, so that
    fitting spreads over the cluster and a block stays within memory; half as many on a side whose
    blocks would mostly be sent copies of the other side's factors.
    Every few iterations the factors are checkpointed to the shared folder, which keeps the
    lineage short and recovery cheap.
    """
    spark = ratings.sparkSession
    ensure_checkpoint_dir(spark)
    if user_blocks is None or product_blocks is None:
        by_users, by_products = _blocks(ratings, rank, iterations)
        user_blocks, product_blocks = user_blocks or by_users, product_blocks or by_products
    als = ALS(
        userCol="user_id",
        itemCol="product_id",
        ratingCol="rating",
        rank=rank,
        maxIter=iterations,
        regParam=regularisation,
        implicitPrefs=implicit,
        numUserBlocks=user_blocks,
        numItemBlocks=product_blocks,
        coldStartStrategy="drop",
        seed=seed,
    )
    # not cached here: fitting reads its input once, into cached blocks of its own
    return als.fit(_training(ratings))


def als_predict(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """``pairs`` with a ``prediction``; pairs of an unknown user or product drop out."""
    ids = [F.col(name).cast("int").alias(name) for name in ("user_id", "product_id")]
    rest = [name for name in pairs.columns if name not in ("user_id", "product_id")]
    return model.transform(pairs.select(*ids, *rest))


def als_recommend(
    model: ALSModel,
    ratings: DataFrame,
    names: DataFrame,
    targets: DataFrame | None = None,
    n: int = 10,
    exclude_rated: bool = True,
    block_users: int = BLOCK_USERS,
    block_products: int = BLOCK_PRODUCTS,
    bounded: bool = True,
) -> DataFrame:
    """The ``n`` best predicted catalogue products of each target (everybody by default).

    A catalogue of more than one block of products is searched by norms, see
    :mod:`kinrank.operators.norm_search`, so that many products are never scored; the result is the same. A smaller one, or any with ``bounded=False``, is
    scored in full: users and products are hashed into blocks. A cell scores one block of
    users against one block of products as a matrix product, blanks out what its users
    already rated, and returns ``n`` products per user. However much a user rated, a cell
    only ever sees the ratings that fall into its block of products.
    """
    users = model.userFactors.withColumnRenamed("id", "user_id")
    if targets is not None:
        chosen = targets.select(F.col("user_id").cast("int").alias("user_id")).distinct()
        users = users.join(chosen, "user_id", "left_semi")
    catalogue = names.select(F.col("product_id").cast("int").alias("id")).distinct()
    products = model.itemFactors.join(catalogue, "id", "left_semi")

    rated = _training(ratings).select("user_id", "product_id")
    if not exclude_rated:
        rated = rated.where(F.lit(False))
    elif targets is not None:
        rated = ratings_of(rated, users)

    n_products = products.count()
    if bounded and n_products > block_products > n:
        return bounded_recommend(
            model, ratings, names, targets, n=n, exclude_rated=exclude_rated, block_users=block_users,
            band_products=block_products,
        )
    # a cell returns n products a user, all of its block where n is larger
    block_users = max(1, min(block_users, CELL_ROWS // max(1, min(n, n_products, block_products))))
    n_users, n_rated = users.count(), rated.count()
    cores = ratings.sparkSession.sparkContext.defaultParallelism
    pb = block_count(Side(n_products, n_products, 1), block_products, block_products, 1)
    ub = block_count(
        Side(n_users, n_rated // pb, 1), block_users, BLOCK_RATINGS, math.ceil(2 * cores / pb)
    )
    every_user_block = F.explode(F.sequence(F.lit(0), F.lit(ub - 1)))
    every_product_block = F.explode(F.sequence(F.lit(0), F.lit(pb - 1)))
    factors = users.select(
        block_of(F.col("user_id"), ub).alias("ub"),
        every_product_block.alias("pb"),
        F.lit(True).alias("is_user"),
        F.col("user_id").alias("id"),
        "features",
    ).unionByName(
        products.select(
            every_user_block.alias("ub"),
            block_of(F.col("id"), pb).alias("pb"),
            F.lit(False).alias("is_user"),
            "id",
            "features",
        )
    )
    rated = rated.select(
        block_of(F.col("user_id"), ub).alias("ub"),
        block_of(F.col("product_id"), pb).alias("pb"),
        "user_id",
        "product_id",
    )
    copied = 8.0 * model.rank * (n_users * pb + n_products * ub) + 16.0 * n_rated
    partitions = cell_partitions(ratings, ub * pb, copied)
    scored = (
        factors.repartition(partitions, "ub", "pb")
        .groupBy("ub", "pb")
        .cogroup(rated.repartition(partitions, "ub", "pb").groupBy("ub", "pb"))
        .applyInArrow(_score_cell(n), "user_id int, product_id int, score double")
    )
    return top_n(scored, n)


def _score_cell(n: int):
    def by_id(factors: pa.Table):
        factors = factors.sort_by("id")
        lists = factors["features"].combine_chunks()
        return factors["id"].to_numpy(), lists.flatten().to_numpy().reshape(len(factors), -1)

    def positions(ids, wanted):
        """Where ``wanted`` are in the sorted ``ids``, and which of them are there."""
        place = np.minimum(np.searchsorted(ids, wanted), len(ids) - 1)
        return place, ids[place] == wanted

    def score(factors: pa.Table, rated: pa.Table) -> pa.Table:
        users = factors.filter(factors["is_user"])
        products = factors.filter(pc.invert(factors["is_user"]))
        found = [OUTPUT.empty_table()]
        if len(users) and len(products):
            user, user_factors = by_id(users)
            product, product_factors = by_id(products)
            row, known_user = positions(user, rated["user_id"].to_numpy())
            column, known_product = positions(product, rated["product_id"].to_numpy())
            known = known_user & known_product
            row, column = row[known], column[known]
            step = max(1, TILE_SCORES // len(product))
            for first in range(0, len(user), step):
                scores = user_factors[first : first + step] @ product_factors.T
                here = (row >= first) & (row < first + step)
                scores[row[here] - first, column[here]] = np.nan
                best_row, best = best_per_row(scores, n)
                top = scores[best_row, best].astype("float64")
                columns = [user[first + best_row], product[best], top]
                found.append(pa.table(columns, schema=OUTPUT))
        return pa.concat_tables(found)

    return score


def als_recommend_adhoc(
    ratings: DataFrame,
    adhoc: DataFrame,
    names: DataFrame,
    n: int = 10,
    **parameters,
) -> DataFrame:
    """Recommend to people who bring their own ratings, under ids nobody else has.

    Their ratings join the training data and the model is fitted anew, once for all of
    them. Marks of 0 ("not seen") are dropped; somebody without any other mark raises, and
    so does a mark outside 0 to 5.
    """
    # checked, fitted, counted and scored: both are derived once
    adhoc, ratings = written(adhoc), written(ratings.select("user_id", "product_id", "rating"))
    mine = require_adhoc(adhoc)
    if not ratings_of(ratings, mine).isEmpty():
        raise ValueError("an ad-hoc user id already has ratings")
    everyone = with_adhoc(ratings, mine)
    return als_recommend(als_fit(everyone, **parameters), mine, names, mine, n)


@dataclass(frozen=True)
class Trial:
    """One fit of a grid; ``place`` is its place in the grid."""

    place: int
    rank: int
    reg: float
    iters: int
    rmse_valid: float | None
    model: ALSModel

    def beats(self, other: Trial | None) -> bool:
        """A smaller finite error, or an equal one at an earlier place."""
        if self.rmse_valid is None or not math.isfinite(self.rmse_valid):
            return False
        return other is None or (self.rmse_valid, self.place) < (other.rmse_valid, other.place)


def als_trials(
    train: DataFrame,
    valid: DataFrame,
    ranks: Iterable[int] = (12,),
    regularisations: Iterable[float] = (0.1, 10.0),
    iterations: Iterable[int] = (10,),
    seed: int = SEED,
    at_once: int = TRIALS_AT_ONCE,
) -> Iterator[Trial]:
    """Fit every combination, ``at_once`` at the same time, and yield trials as they finish.

    Each trial runs in a thread of its own, whose jobs share one tag and a scheduler pool; with a fair
    scheduler (``spark.scheduler.mode``) they share the cluster evenly, so that one fit's small last stages
    leave cores to the others. If a trial fails, or the caller stops, the jobs of all others are cancelled.
    """
    spark = train.sparkSession
    context, tag = spark.sparkContext, f"grid-{uuid.uuid4().hex}"

    def run(place: int, rank: int, reg: float, iters: int) -> Trial:
        context.addJobTag(tag)
        context.setLocalProperty("spark.scheduler.pool", f"{tag}-{place}")
        try:
            model = als_fit(train, rank, iters, reg, seed=seed)
            error = rmse_of_predicted(als_predict(model, valid), valid).first()["rmse"]
        finally:
            context.setLocalProperty("spark.scheduler.pool", None)
            context.removeJobTag(tag)
        return Trial(place, rank, reg, iters, error, model)

    points = list(enumerate(grid(ranks, regularisations, iterations)))
    # Threads of their own Spark properties, which start with those of the caller.
    target = inheritable_thread_target(spark)(run)
    pool = ThreadPoolExecutor(max(1, at_once), thread_name_prefix=tag)
    waiting = [pool.submit(target, place, *point) for place, point in points]
    done = False
    try:
        for trial in as_completed(waiting):
            yield trial.result()
        done = True
    finally:
        if not done:
            for trial in waiting:
                trial.cancel()
            context.cancelJobsWithTag(tag)
        pool.shutdown()


def als_grid(
    train: DataFrame,
    valid: DataFrame,
    test: DataFrame,
    ranks: Iterable[int] = (12,),
    regularisations: Iterable[float] = (0.1, 10.0),
    iterations: Iterable[int] = (10,),
    seed: int = SEED,
    at_once: int = TRIALS_AT_ONCE,
) -> DataFrame:
    """Fit every combination, keep the one with the least validation error, test it.

    One row per combination, in the order of the grid: rank, reg, iters, rmse_valid, is_best,
    rmse_test (of the best only). Errors are over all held-out rows; the first of equals wins,
    whichever finishes first. A model that scored nothing, or whose error is not finite, never wins; if none
    is left, this raises. Of the models only the best so far is kept. The driver sees one number per fit.
    """
    spark = train.sparkSession
    parts = [part.select("user_id", "product_id", "rating") for part in (train, valid, test)]
    # read by every fit; written, so that a lost executor does not derive them again
    train, valid, test = map(written, parts)
    tried, best = {}, None
    try:
        for trial in als_trials(train, valid, ranks, regularisations, iterations, seed, at_once):
            tried[trial.place] = (trial.rank, trial.reg, trial.iters, trial.rmse_valid)
            if trial.beats(best):
                best = trial
        if best is None:
            raise ValueError("no combination has a finite validation error")
        tested = rmse_of_predicted(als_predict(best.model, test), test).first()["rmse"]
    finally:
        for part in (train, valid, test):
            forget(part)
    rows = [
        (*tried[i], i == best.place, tested if i == best.place else None) for i in sorted(tried)
    ]
    return spark.createDataFrame(
        rows,
        "rank int, reg double, iters int, rmse_valid double, is_best boolean, rmse_test double",
    )


def als_implicit_rmse(split: DataFrame, **parameters) -> DataFrame:
    """Fit signed confidences implicitly and test them against 0/1 labels.

    ``split`` is labelled 1..5 ratings. Predictions are clamped to 0..1; the error is over
    the scored rows.
    """
    shifted = split.withColumn("rating", implicit_shift(F.col("rating").cast("double")))
    test = shifted.where(F.col("split") == TEST).withColumn(
        "rating", binary_label(F.col("rating"))
    )
    model = als_fit(shifted.where(F.col("split") == TRAIN), implicit=True, **parameters)
    return rmse_of_predicted(als_predict(model, test), clamped=True)
