"""What neighbours rated the products that users are tested on, asked for in packed rows.

A user's held-out products would have to be joined with 25 neighbours each. Instead users are hashed to buckets; a bucket's
questions to another are one row of arrays, which goes to the ratings of that bucket, and comes back with what was found.
So a task holds the ratings of one bucket, and its questions.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinrank.functions.scores import block_of
from kinrank.operators.blocks import cell_partitions

# Ratings of a bucket of users.
BUCKET_RATINGS = 250_000
# Places of a table of users and products, for each rating in it, and at least.
TABLE_SHARE, TABLE_LEAST = 16, 1 << 20


class Places:
    """The positions of (user, product) pairs, each there once."""

    def __init__(self, user: np.ndarray, product: np.ndarray):
        self.users, of_user = np.unique(user, return_inverse=True)
        self.products, of_product = np.unique(product, return_inverse=True)
        key = of_user * len(self.products) + of_product
        self.table = None
        size = len(self.users) * len(self.products)
        if size <= max(TABLE_LEAST, TABLE_SHARE * len(key)):
            self.table = np.full(size, -1, dtype=np.int32)
            self.table[key] = np.arange(len(key))
        else:
            self.order = np.argsort(key)
            self.sorted = key[self.order]

    def find(self, user: np.ndarray, times: np.ndarray, product: np.ndarray) -> np.ndarray:
        """Where users have these products, -1 if they have not; ``times`` says how many belong to each user."""
        if not len(self.users):
            return np.full(len(product), -1)
        u = np.minimum(np.searchsorted(self.users, user), len(self.users) - 1)
        p = np.minimum(np.searchsorted(self.products, product), len(self.products) - 1)
        key = np.repeat(u * len(self.products), times) + p
        if self.table is not None:
            place = self.table[key]
        else:
            at = np.minimum(np.searchsorted(self.sorted, key), len(self.sorted) - 1)
            place = np.where(self.sorted[at] == key, self.order[at], -1)
        return np.where(np.repeat(self.users[u] == user, times) & (self.products[p] == product), place, -1)


def columns_of(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [table.column(name).to_numpy() for name in names]


def list_values(table: pa.Table, *names: str) -> list[np.ndarray]:
    """The values of all lists of each column, one after another."""
    return [pa.concat_arrays([chunk.flatten() for chunk in table.column(name).chunks]).to_numpy() if table.num_rows else np.zeros(0) for name in names]


def cut(values: np.ndarray, ends: np.ndarray, dtype: pa.DataType) -> pa.Array:
    """Values as lists that end there."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(values, dtype))


QUESTIONS = "asked int, home int, user_id array<bigint>, fold array<int>, neighbour_id array<bigint>, sim array<double>, n array<int>, product_id array<bigint>"
ANSWERS = "home int, user_id array<bigint>, sim array<double>, n array<int>, product_id array<bigint>, rating array<double>"
SUMS = "user_id bigint, product_id bigint, rating double, fold int, n bigint, num double, den double"


def _questions(key: tuple[pa.Scalar, ...], near: pa.Table, ratings: pa.Table) -> pa.Table:
    """What a bucket's users ask of every other: each neighbour about the products of a fold."""
    user, fold, neighbour, sim, asked = columns_of(near, "user_id", "fold", "neighbour_id", "sim", "asked")
    rater, product, rated_fold = columns_of(ratings, "user_id", "product_id", "fold")
    raters = np.unique(rater)
    known = np.isin(user, raters)
    user, fold, neighbour, sim, asked = (c[known] for c in (user, fold, neighbour, sim, asked))
    folds = int(max(rated_fold.max(initial=0), fold.max(initial=0))) + 1
    held = np.searchsorted(raters, rater) * folds + rated_fold
    product = product[np.argsort(held, kind="stable")]
    count = np.bincount(held, minlength=len(raters) * folds)
    starts = np.cumsum(count) - count
    order = np.argsort(asked, kind="stable")
    user, fold, neighbour, sim, asked = (c[order] for c in (user, fold, neighbour, sim, asked))
    held = np.searchsorted(raters, user) * folds + fold
    n = count[held]
    place = np.repeat(starts[held] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    ends = np.append(np.flatnonzero(np.diff(asked)) + 1, len(asked)) if len(asked) else np.zeros(0, dtype=np.int64)
    last = ends - 1
    return pa.Table.from_pydict(
        {
            "asked": pa.array(asked[last], pa.int32()),
            "home": pa.array(np.full(len(ends), key[0].as_py()), pa.int32()),
            "user_id": cut(user, ends, pa.int64()),
            "fold": cut(fold, ends, pa.int32()),
            "neighbour_id": cut(neighbour, ends, pa.int64()),
            "sim": cut(sim, ends, pa.float64()),
            "n": cut(n, ends, pa.int32()),
            "product_id": cut(product[place], np.cumsum(n)[last], pa.int64()),
        }
    )


def _answers(questions: pa.Table, ratings: pa.Table) -> pa.Table:
    """Ratings that neighbours have outside the fold they are asked about, question after question."""
    rater, rated, rating, rated_fold = columns_of(ratings, "user_id", "product_id", "rating", "fold")
    places = Places(rater, rated)
    rows = []
    for i in range(questions.num_rows):
        row = questions.slice(i, 1)
        user, fold, neighbour, sim, n, product = list_values(row, "user_id", "fold", "neighbour_id", "sim", "n", "product_id")
        place = places.find(neighbour, n, product)
        found = (place >= 0) & (rated_fold[place] != np.repeat(fold, n)) if len(rated) else place >= 0
        n = np.bincount(np.repeat(np.arange(len(n)), n)[found], minlength=len(n))
        some = n > 0
        lists = (user[some], sim[some], n[some], product[found], rating[place[found]])
        types = (pa.int64(), pa.float64(), pa.int32(), pa.int64(), pa.float64())
        rows.append([row.column("home").combine_chunks(), *(cut(v, [len(v)], t) for v, t in zip(lists, types, strict=True))])
    names = ["home", "user_id", "sim", "n", "product_id", "rating"]
    return pa.Table.from_batches([pa.RecordBatch.from_arrays(row, names) for row in rows]) if rows else _EMPTY_ANSWERS


_EMPTY_ANSWERS = pa.table(
    {
        "home": pa.array([], pa.int32()),
        **{name: pa.array([], pa.list_(t)) for name, t in (("user_id", pa.int64()), ("sim", pa.float64()), ("n", pa.int32()), ("product_id", pa.int64()), ("rating", pa.float64()))},
    }
)


def _sums(ratings: pa.Table, answers: pa.Table) -> pa.Table:
    """Every rating with what was found: how many, and the weighted and plain sums of similarities."""
    rater, rated = columns_of(ratings, "user_id", "product_id")
    places = Places(rater, rated)
    n, num, den = np.zeros(len(rated), dtype=np.int64), np.zeros(len(rated)), np.zeros(len(rated))
    for i in range(answers.num_rows):
        user, sim, count, product, rating = list_values(answers.slice(i, 1), "user_id", "sim", "n", "product_id", "rating")
        place, sim = places.find(user, count, product), np.repeat(sim, count)
        np.add.at(n, place, 1)
        np.add.at(num, place, sim * rating)
        np.add.at(den, place, sim)
    kept = ratings.select(["user_id", "product_id", "rating", "fold"])
    return kept.append_column("n", pa.array(n)).append_column("num", pa.array(num)).append_column("den", pa.array(den))


def held_out_sums(neighbours: DataFrame, ratings: DataFrame) -> DataFrame:
    """Each rating with the ratings its user's neighbours have of the product outside its fold.

    ``neighbours`` are ``fold, user_id, neighbour_id, sim``. Returns ``user_id, product_id, rating, fold, n, num, den``:
    how many neighbours rated the product, and their ratings times similarity and similarities added up.
    """
    rows = ratings.count()
    cores = ratings.sparkSession.sparkContext.defaultParallelism
    buckets = max(1, math.ceil(rows / BUCKET_RATINGS), min(2 * cores, rows // 1000))
    home = block_of(F.col("user_id"), buckets)
    rated = ratings.withColumn("home", home)
    near = neighbours.select(
        "fold", "user_id", "neighbour_id", "sim", home.alias("home"), block_of(F.col("neighbour_id"), buckets).alias("asked")
    )
    partitions = cell_partitions(ratings, 16 * buckets)

    def dealt(frame: DataFrame, key: str):
        return frame.repartition(partitions, key).groupBy(key)

    questions = dealt(near, "home").cogroup(dealt(rated, "home")).applyInArrow(_questions, QUESTIONS)
    answers = dealt(questions, "asked").cogroup(dealt(rated, "home")).applyInArrow(_answers, ANSWERS)
    return dealt(rated, "home").cogroup(dealt(answers, "home")).applyInArrow(_sums, SUMS)
