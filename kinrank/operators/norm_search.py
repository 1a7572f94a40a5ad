"""The best products of each user without scoring every product: a search bounded by norms.

No score exceeds the product of the two norms (Cauchy-Schwarz). A cell has a block of users and a
slice of the catalogue, which is large, so that a user is sent to few cells and at most ``n`` products
a user leave each. Inside a cell products come in tiles of descending norm, and a user leaves when the
next tile can't reach their ``n``-th score. Nothing is approximate: what is left out can't be among
the best ``n``. A task holds the factors of its cell and the ``n`` best so far.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinrank.functions.scores import block_of
from kinrank.operators.blocks import Side, best_per_row, block_count, cell_partitions
from kinrank.operators.topn import top_n
from kinrank.session import written

# Large blocks keep the copies of the factors few; tiles keep the arrays of a task small.
BLOCK_USERS = 65_536
BLOCK_RATINGS = 4_000_000
BAND_PRODUCTS = 8192
SLICE_PRODUCTS = 262_144
# Rows that leave a cell.
CELL_ROWS = 2_000_000
TILE_PRODUCTS = 512
TILE_USERS = 1024
# Tiles grow up to this many times.
LARGER_TILES = 16
# Bounds are raised by this share, far more than sums of doubles lose.
SLACK = 1e-6

FOUND = pa.schema(
    [("user_id", pa.int32()), ("product_id", pa.int32()), ("score", pa.float64()), ("scored", pa.int64())]
)


def _norm(features: str = "features") -> Column:
    squares = F.transform(features, lambda x: x.cast("double") * x.cast("double"))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, x: total + x))


def known_catalogue(model: ALSModel, names: DataFrame) -> DataFrame:
    """``product_id, features, bound`` of the products that have factors and a name.

    ``bound`` is at least the norm.
    """
    catalogue = names.select(F.col("product_id").cast("int").alias("id")).distinct()
    return model.itemFactors.join(catalogue, "id", "left_semi").select(
        F.col("id").alias("product_id"), "features", (_norm() * (1 + SLACK)).alias("bound")
    )


def _best_of_users(user, rows, product, columns, bound, at_row, at_column, n: int, tile_products: int):
    """The ``n`` best products of some users, from the largest norm down, and how many were scored.

    ``product`` and ``columns`` are in the order of descending ``bound``; ``at_row`` and
    ``at_column``, by column, are the pairs that don't count.
    """
    norms = np.sqrt((rows * rows).sum(axis=1))
    best_score = np.full((len(user), n), -np.inf)
    best_product = np.full((len(user), n), np.iinfo(np.int32).max, dtype=np.int32)
    scored = np.zeros(len(user), dtype=np.int64)
    low, most = 0, LARGER_TILES * tile_products
    while low < len(product):
        high = min(low + tile_products, len(product))
        needed = best_score[:, -1]
        # Zero times infinity can't occur: bounds are finite, and no score asks for nothing.
        active = np.flatnonzero((norms * bound[low] >= needed) | ~np.isfinite(needed))
        if not len(active):
            break
        scored[active] += high - low
        tile = low + np.argsort(product[low:high])
        column_of = np.empty(high - low, dtype=np.int64)
        column_of[tile - low] = np.arange(high - low)
        scores = rows[active] @ columns[tile].T
        a, b = np.searchsorted(at_column, [low, high])
        spot = np.minimum(np.searchsorted(active, at_row[a:b]), len(active) - 1)
        here = active[spot] == at_row[a:b]
        scores[spot[here], column_of[at_column[a:b][here] - low]] = np.nan
        wanted = scores >= needed[active, None]
        if np.count_nonzero(wanted) > 2 * n * len(active):
            row, column = best_per_row(scores, n)
        else:
            row, column = np.divmod(np.flatnonzero(wanted), high - low)
        # Only users with a new candidate are ranked anew; ties go to the lower id.
        touched, place = np.unique(row, return_inverse=True)
        who = active[touched]
        every = np.concatenate([np.repeat(np.arange(len(who)), n), place])
        score = np.concatenate([best_score[who].ravel(), scores[row, column]])
        which = np.concatenate([best_product[who].ravel(), product[tile[column]]])
        order = np.lexsort((which, -score, every))
        rank = np.arange(len(order)) - np.searchsorted(every[order], every[order])
        order = order[rank < n]
        best_score[who], best_product[who] = score[order].reshape(-1, n), which[order].reshape(-1, n)
        # Candidates get rarer with every product, so that users are ranked anew less often.
        low, tile_products = high, min(2 * tile_products, most)
    return best_score, best_product, scored


def _search_cell(n: int, tile_products: int):
    """Scores the users of a cell against its products, some users at a time."""

    def matrix(table: pa.Table) -> np.ndarray:
        flat = table["features"].combine_chunks().flatten().to_numpy()
        return flat.reshape(len(table), -1).astype(np.float64)

    def search(cell: pa.Table, rated: pa.Table) -> pa.Table:
        users = cell.filter(cell["is_user"]).sort_by("id")
        products = cell.filter(pc.invert(cell["is_user"])).sort_by([("bound", "descending"), ("id", "ascending")])
        if not len(users) or not len(products):
            return FOUND.empty_table()
        user, product, bound = users["id"].to_numpy(), products["id"].to_numpy(), products["bound"].to_numpy()
        rows, columns = matrix(users), matrix(products)
        rated_user, rated_product = rated["user_id"].to_numpy(), rated["product_id"].to_numpy()
        by_id = np.argsort(product)
        place = np.minimum(np.searchsorted(product, rated_product, sorter=by_id), len(product) - 1)
        at_row = np.minimum(np.searchsorted(user, rated_user), len(user) - 1)
        known = (product[by_id[place]] == rated_product) & (user[at_row] == rated_user)
        at_row, at_column = at_row[known], by_id[place[known]]
        order = np.lexsort((at_column, at_row // TILE_USERS))
        at_row, at_column = at_row[order], at_column[order]
        found = []
        for first in range(0, len(user), TILE_USERS):
            some = slice(first, first + TILE_USERS)
            a, b = np.searchsorted(at_row // TILE_USERS, [first // TILE_USERS, first // TILE_USERS + 1])
            score, which, scored = _best_of_users(
                user[some], rows[some], product, columns, bound, at_row[a:b] - first, at_column[a:b], n, tile_products
            )
            row, place = np.nonzero(np.isfinite(score))
            nothing = pa.nulls(len(scored))
            found += [
                pa.table([user[some][row], which[row, place], score[row, place], pa.nulls(len(row), pa.int64())], schema=FOUND),
                # How many products each user was multiplied with.
                pa.table([user[some], nothing.cast(pa.int32()), nothing.cast(pa.float64()), scored], schema=FOUND),
            ]
        return pa.concat_tables(found)

    return search


def search_products(
    model: ALSModel,
    ratings: DataFrame,
    names: DataFrame,
    targets: DataFrame | None = None,
    n: int = 10,
    exclude_rated: bool = True,
    block_users: int = BLOCK_USERS,
    band_products: int = BAND_PRODUCTS,
) -> DataFrame:
    """Candidates for the ``n`` best: ``user_id, product_id, score``, and for each cell a user was
    in a row without product that says how many products were ``scored``.

    The table is written; :func:`bounded_recommend` and :func:`search_work` read it.
    """
    spark = ratings.sparkSession
    users = model.userFactors.select(F.col("id").alias("user_id"), "features")
    if targets is not None:
        chosen = targets.select(F.col("user_id").cast("int").alias("user_id")).distinct()
        users = users.join(chosen, "user_id", "left_semi")
    products = known_catalogue(model, names)
    n_users, n_products = users.count(), products.count()
    rated = ratings.select(F.col("user_id").cast("int").alias("user_id"), F.col("product_id").cast("int").alias("product_id"))
    if not exclude_rated:
        rated = rated.where(F.lit(False))
    elif targets is not None:
        rated = rated.join(users.select("user_id"), "user_id", "left_semi")
    rated = written(rated)
    cores, n_rated = spark.sparkContext.defaultParallelism, rated.count()
    slices = max(1, math.ceil(n_products / SLICE_PRODUCTS))
    block_users = max(1, min(block_users, CELL_ROWS // n))
    blocks = block_count(Side(n_users, n_rated // slices, 1), block_users, BLOCK_RATINGS, math.ceil(2 * cores / slices))
    # Few users leave cores to slices of the catalogue, as long as a slice keeps several bands.
    slices = max(slices, min(math.ceil(2 * cores / blocks), n_products // (8 * band_products)))
    every_slice = F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    cells = users.select(
        block_of(F.col("user_id"), blocks).alias("ub"),
        every_slice.alias("slice"),
        F.lit(True).alias("is_user"),
        F.col("user_id").alias("id"),
        "features",
        F.lit(None).cast("double").alias("bound"),
    ).unionByName(
        products.select(
            every_block.alias("ub"),
            block_of(F.col("product_id"), slices).alias("slice"),
            F.lit(False).alias("is_user"),
            F.col("product_id").alias("id"),
            "features",
            "bound",
        )
    )
    pairs = rated.select(
        block_of(F.col("user_id"), blocks).alias("ub"),
        block_of(F.col("product_id"), slices).alias("slice"),
        "user_id",
        "product_id",
    )
    copied = 8.0 * model.rank * (n_users * slices + n_products * blocks) + 16.0 * n_rated
    partitions = cell_partitions(ratings, blocks * slices, copied)
    found = (
        cells.repartition(partitions, "ub", "slice")
        .groupBy("ub", "slice")
        .cogroup(pairs.repartition(partitions, "ub", "slice").groupBy("ub", "slice"))
        .applyInArrow(
            _search_cell(n, min(TILE_PRODUCTS, band_products)), "user_id int, product_id int, score double, scored bigint"
        )
    )
    return written(found)


def bounded_recommend(model: ALSModel, ratings: DataFrame, names: DataFrame, *args, n: int = 10, **options) -> DataFrame:
    """The ``n`` best predicted catalogue products of each target: ``user_id, pos, product_id, score``.

    The same as scoring every product; ties go to the lower id. Takes the options of
    :func:`search_products`.
    """
    found = search_products(model, ratings, names, *args, n=n, **options)
    return top_n(found.where(F.col("product_id").isNotNull()), n)


def search_work(found: DataFrame, names: DataFrame, model: ALSModel) -> DataFrame:
    """Per user how many products were ``scored`` and how many ``skipped``."""
    n_products = known_catalogue(model, names).agg(F.count("*")).scalar()
    scored = found.where(F.col("scored").isNotNull()).groupBy("user_id").agg(F.sum("scored").alias("scored"))
    return scored.select("user_id", "scored", (n_products - F.col("scored")).alias("skipped"))


def _count_above(factors: pa.Table, taken: pa.Table) -> pa.Table:
    """For the users of a cell how many of its products, none of those taken, score above a mark."""
    users, products = factors.filter(factors["is_user"]).sort_by("id"), factors.filter(pc.invert(factors["is_user"])).sort_by("id")
    schema = pa.schema([("user_id", pa.int32()), ("n_above", pa.int64()), ("n_free", pa.int64()), ("id_sum", pa.int64())])
    if not len(users) or not len(products):
        return schema.empty_table()
    user, product, mark = users["id"].to_numpy(), products["id"].to_numpy(), users["mark"].to_numpy()
    rows, columns = (
        t["features"].combine_chunks().flatten().to_numpy().reshape(len(t), -1).astype(np.float64) for t in (users, products)
    )
    at_row = np.minimum(np.searchsorted(user, taken["user_id"].to_numpy()), len(user) - 1)
    at_column = np.minimum(np.searchsorted(product, taken["product_id"].to_numpy()), len(product) - 1)
    known = (user[at_row] == taken["user_id"].to_numpy()) & (product[at_column] == taken["product_id"].to_numpy())
    at_row, at_column = at_row[known], at_column[known]
    found = []
    for first in range(0, len(user), TILE_USERS):
        scores = rows[first : first + TILE_USERS] @ columns.T
        here = (at_row >= first) & (at_row < first + TILE_USERS)
        free = np.ones(scores.shape, dtype=bool)
        free[at_row[here] - first, at_column[here]] = False
        above = free & (scores > mark[first : first + TILE_USERS, None])
        found.append((above.sum(axis=1), free.sum(axis=1), free @ product.astype(np.int64)))
    above, free, total = (np.concatenate(parts).astype(np.int64) for parts in zip(*found, strict=True))
    return pa.table([user, above, free, total], schema=schema)


def products_above(
    model: ALSModel, names: DataFrame, marks: DataFrame, taken: DataFrame, block_users: int = 8192, block_products: int = 2048
) -> DataFrame:
    """Per user of ``marks`` (``user_id, mark``), of the catalogue without the ``taken`` pairs: ``n_above``
    products that score above the mark, ``n_free`` products, ``id_sum`` of their ids.

    Every product is scored, with no bound: a check of :func:`bounded_recommend`, as costly as
    what it replaces. One row per user and block of products leaves a task.
    """
    products = known_catalogue(model, names).select("product_id", "features")
    users = model.userFactors.select(F.col("id").alias("user_id"), "features").join(
        marks.select(F.col("user_id").cast("int").alias("user_id"), "mark"), "user_id"
    )
    ub = max(1, math.ceil(users.count() / block_users))
    pb = max(1, math.ceil(products.count() / block_products))
    factors = users.select(
        block_of(F.col("user_id"), ub).alias("ub"),
        F.explode(F.sequence(F.lit(0), F.lit(pb - 1))).alias("pb"),
        F.lit(True).alias("is_user"),
        F.col("user_id").alias("id"),
        "features",
        "mark",
    ).unionByName(
        products.select(
            F.explode(F.sequence(F.lit(0), F.lit(ub - 1))).alias("ub"),
            block_of(F.col("product_id"), pb).alias("pb"),
            F.lit(False).alias("is_user"),
            F.col("product_id").alias("id"),
            "features",
            F.lit(None).cast("double").alias("mark"),
        )
    )
    pairs = taken.select(
        block_of(F.col("user_id"), ub).alias("ub"),
        block_of(F.col("product_id"), pb).alias("pb"),
        F.col("user_id").cast("int").alias("user_id"),
        F.col("product_id").cast("int").alias("product_id"),
    )
    partitions = cell_partitions(factors, ub * pb, 8.0 * model.rank * ub * pb * (block_users + block_products))
    counted = (
        factors.repartition(partitions, "ub", "pb")
        .groupBy("ub", "pb")
        .cogroup(pairs.repartition(partitions, "ub", "pb").groupBy("ub", "pb"))
        .applyInArrow(_count_above, "user_id int, n_above bigint, n_free bigint, id_sum bigint")
    )
    return counted.groupBy("user_id").agg(*[F.sum(c).alias(c) for c in ("n_above", "n_free", "id_sum")])


def best_possible(model: ALSModel, names: DataFrame, recommended: DataFrame, rated: DataFrame, n: int) -> DataFrame:
    """Per user ``n_recommended``, ``n_above``, ``n_missing``: is there any better product?

    ``n_above`` counts the products, neither recommended nor ``rated``, that score above the
    last one recommended; ``n_missing`` those that could have filled up to ``n``. Users nothing
    was recommended to are there, too.
    """
    last = recommended.groupBy("user_id").agg(F.count("*").alias("n_recommended"), F.min("score").alias("last"))
    users = model.userFactors.select(F.col("id").alias("user_id"))
    marks = users.join(last, "user_id", "left").select(
        "user_id",
        F.coalesce("n_recommended", F.lit(0)).alias("n_recommended"),
        # Sums of doubles in another order differ by less than this.
        (F.coalesce("last", F.lit(-math.inf)) + 1e-9).alias("mark"),
    )
    marks = written(marks)
    pair = [F.col(c).cast("int").alias(c) for c in ("user_id", "product_id")]
    taken = rated.select(*pair).unionByName(recommended.select(*pair))
    counted = products_above(model, names, marks, taken)
    missing = F.least(F.lit(n) - F.col("n_recommended"), F.coalesce("n_free", F.lit(0)))
    return marks.join(counted, "user_id", "left").select(
        "user_id", "n_recommended", F.coalesce("n_above", F.lit(0)).alias("n_above"), missing.alias("n_missing")
    )
