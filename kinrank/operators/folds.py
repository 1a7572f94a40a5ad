"""Neighbourhood errors of all folds from one set of cells.

A fold's training data are all ratings but its own. A cell of two blocks of users receives their
ratings once, with the fold of each, and adds up the products two users have in common for one fold
after the other, without its ratings; the cells are formed and shuffled once, not once a fold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinrank.operators.blocks import Nearest, RunningSums, Side, cell_partitions, corated_sums, tile_buffer
from kinrank.operators.lookups import cut, held_out_sums, list_values
from kinrank.operators.neighbours import (
    BLOCK_USERS,
    LEAST_RATERS,
    NEIGHBOURS,
    all_blocks,
    cell_tiles,
    meet,
    product_cells,
    same_block,
    with_block,
)
from kinrank.operators.packed import RANKED_USERS

# What cells pack of the neighbours they found.
FOUND = {"user_id": pa.int64(), "neighbour_id": pa.int64(), "n": pa.int32(), "sim": pa.float64()}
# Users whose neighbours of all cells are ranked at once.
USERS_PER_STEP = 4096
# Blocks whose cells are so few that each gets a partition of its own, and the most partitions a block for that.
LONE_BLOCKS, SPREAD = 16, 128


def typed_folds(ratings: DataFrame) -> DataFrame:
    return ratings.select(
        F.col("user_id").cast("bigint").alias("user_id"),
        F.col("product_id").cast("bigint").alias("product_id"),
        F.col("rating").cast("double").alias("rating"),
        F.col("fold").cast("int").alias("fold"),
    )


class FoldSums(RunningSums):
    """Grid 0 sums over all products in common, grid f over those that fold f takes away."""

    def __init__(self, folds: int, rows: int = 0, columns: int = 0):
        super().__init__(rows, columns, folds + 1)
        self.folds = folds

    @staticmethod
    def _only(mask: np.ndarray, raters: np.ndarray, *values: np.ndarray):
        """The ratings of ``mask``, and how many of them each product has."""
        owner = np.repeat(np.arange(len(raters)), raters)
        return (*(v[mask] for v in values), np.bincount(owner[mask], minlength=len(raters)))

    def add_folds(self, user, x, x_fold, user_raters, other, y, y_fold, other_raters) -> None:
        """As ``add``, with the fold of each rating."""
        u, v = self.place(user, other)
        corated_sums(u, x, user_raters, v, y, other_raters, sums=self.grids[0])
        for fold in range(1, self.folds + 1):
            mine, theirs = x_fold == fold, y_fold == fold
            if mine.any():
                # the one's rating goes, whatever fold the other's is in
                some = self._only(mine, user_raters, u, x)
                corated_sums(*some, v, y, other_raters, sums=self.grids[fold])
            if theirs.any():
                # the other's goes, the one's does not
                rest = self._only(~mine, user_raters, u, x)
                some = self._only(theirs, other_raters, v, y)
                corated_sums(*rest, *some, sums=self.grids[fold])


def _nearest_by_fold(folds: int, k: int, parts: int):
    def nearest(
        key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]
    ) -> Iterator[pa.RecordBatch]:
        mine, theirs = cell_tiles(batches, extra=True)
        same, buffer = same_block(mine, theirs), tile_buffer(mine, theirs)
        own = sum(-(-len(tile.ids) // RANKED_USERS) for tile in mine)
        for fold in range(1, folds + 1):
            left = [tile.without(fold) for tile in mine]
            others = left if same else [tile.without(fold) for tile in theirs]
            for i, best in enumerate(meet(left, others, k, True, same, buffer)):
                yield _packed_best(key[0 if i < own else 1].as_py(), fold, best.found(), parts)

    return nearest


def part_of(user: np.ndarray, parts: int) -> np.ndarray:
    """Users of a block spread over its parts."""
    return user % 1_000_003 * 7919 % 65_537 % parts


def _packed_best(block: int, fold: int, found: dict[str, np.ndarray], parts: int) -> pa.RecordBatch:
    """Neighbours that a cell found for some users of a block, a row for each part of the block."""
    part = part_of(found["user_id"], parts)
    order = np.argsort(part, kind="stable")
    part = part[order]
    ends = np.append(np.flatnonzero(np.diff(part)) + 1, len(part)) if len(part) else np.zeros(0, dtype=np.int64)
    lists = {name: cut(found[name][order], ends, dtype) for name, dtype in FOUND.items()}
    cell = {"block": np.full(len(ends), block), "fold": np.full(len(ends), fold), "part": part[ends - 1]}
    return pa.RecordBatch.from_pydict({**{name: pa.array(v, pa.int32()) for name, v in cell.items()}, **lists})


def _best_of_cells(k: int):
    def best(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        user, other, n, sim = list_values(pa.Table.from_batches(batches), *FOUND)
        users, row = np.unique(user, return_inverse=True)
        for first in range(0, len(users), USERS_PER_STEP):
            some = np.flatnonzero((row >= first) & (row < first + USERS_PER_STEP))
            nearest = Nearest(users[first : first + USERS_PER_STEP], k)
            nearest.add(row[some] - first, other[some], sim[some], n[some])
            found = nearest.found()
            rank = np.arange(len(found["n"])) - np.searchsorted(found["user_id"], found["user_id"]) + 1
            fold = np.full(len(rank), key[1].as_py(), dtype=np.int32)
            yield pa.RecordBatch.from_pydict({"fold": fold, **found, "rank": rank.astype(np.int32)})

    return best


def lone_partitions(spark: SparkSession, blocks: int) -> int:
    """The fewest partitions, within some a block, that most cells of every two blocks are alone in.

    A cell is minutes of work, so the others would wait for two in one partition.
    """
    sides = spark.range(blocks).select(F.col("id").cast("int").alias("tb"))
    cells = sides.crossJoin(sides.withColumnRenamed("tb", "ub")).where("tb <= ub")
    hashes = np.array([row[0] for row in cells.select(F.hash("tb", "ub")).collect()])
    return max(range(len(hashes), SPREAD * blocks + 1), key=lambda n: (len(np.unique(hashes % n)), -n))


def fold_neighbours(
    ratings: DataFrame, folds: int, k: int = NEIGHBOURS, block_users: int | None = None
) -> DataFrame:
    """The ``k`` most similar users of everybody, for each fold 1..``folds`` without its ratings.

    ``ratings`` have a ``fold``, and are unique per user and product. Returns ``fold, user_id,
    neighbour_id, n, sim, rank`` as ``user_neighbours`` does for the other folds alone. A cell holds
    the ratings of its two blocks once, and takes one fold after the other.
    """
    ratings = typed_folds(ratings)
    side = Side.of(ratings)
    cores = ratings.sparkSession.sparkContext.defaultParallelism
    blocks = all_blocks(side, block_users or BLOCK_USERS, cores)
    dealt = with_block(ratings, blocks)
    if blocks <= LONE_BLOCKS:
        partitions = lone_partitions(ratings.sparkSession, blocks)
    else:
        partitions = cell_partitions(ratings, blocks * blocks, 48.0 * side.rows * blocks)
    found = (
        product_cells(dealt, dealt, extra="fold", once=True)
        .repartition(partitions, "tb", "ub")
        .groupBy("tb", "ub")
        .applyInArrow(
            _nearest_by_fold(folds, k, blocks),
            "block int, fold int, part int, user_id array<bigint>, neighbour_id array<bigint>, n array<int>, sim array<double>",
        )
    )
    # every user is in as many cells as there are blocks
    partitions = cell_partitions(ratings, blocks * blocks * folds, 20.0 * k * side.keys * blocks * folds)
    return (
        found.repartition(partitions, "block", "fold", "part")
        .groupBy("block", "fold", "part")
        .applyInArrow(
            _best_of_cells(k), "fold int, user_id bigint, neighbour_id bigint, n bigint, sim double, rank int"
        )
    )


def _without_fold(values: list[float | None], pick) -> Column:
    """For each fold the least or greatest of the other folds' values."""
    others = [[v for f, v in enumerate(values) if f != fold and v is not None] for fold in range(len(values))]
    cells = F.array(*[F.lit(pick(o) if o else None).cast("double") for o in others])
    return F.element_at(cells, F.col("fold"))


def fold_estimates(neighbours: DataFrame, ratings: DataFrame, folds: int) -> DataFrame:
    """Each rating estimated from the other folds: ``fold, user_id, product_id, rating, n, score``.

    The mean of the neighbours' ratings weighted by similarity, kept within those observed in the other
    folds; null with fewer than two neighbours who rated the product there.
    """
    ratings = typed_folds(ratings)
    seen = {r["fold"]: (r["low"], r["high"]) for r in ratings.groupBy("fold").agg(F.min("rating").alias("low"), F.max("rating").alias("high")).collect()}
    low, high = ([seen.get(f, (None, None))[side] for f in range(1, folds + 1)] for side in (0, 1))
    mean = F.col("num") / F.col("den")
    score = F.round(F.greatest(F.least(mean, _without_fold(high, max)), _without_fold(low, min)), 6)
    # similarities that cancel out leave rounding noise instead of zero
    enough = (F.col("n") >= LEAST_RATERS) & (F.round("den", 9) != 0)
    return held_out_sums(neighbours, ratings).select(
        "fold", "user_id", "product_id", "rating", F.when(enough, F.col("n")).alias("n"), F.when(enough, score).alias("score")
    )


def knn_fold_errors(ratings: DataFrame, folds: int = 5, k: int = NEIGHBOURS) -> DataFrame:
    """One row per fold: ``fold, n_test, n_scored, mae``, each fold estimated from the others.

    ``ratings`` have a ``fold``, as from ``split_kfold``. Ratings without an estimate are counted but
    not averaged.
    """
    estimates = fold_estimates(fold_neighbours(ratings, folds, k), ratings, folds)
    return estimates.groupBy("fold").agg(
        F.count("*").alias("n_test"),
        F.count("score").alias("n_scored"),
        F.avg(F.abs(F.col("score") - F.col("rating"))).alias("mae"),
    )
