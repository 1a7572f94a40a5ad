"""Factors for people a model has never seen, from their own ratings and its product factors.

With the products held fixed, a person's factors solve one small system of equations. Its
matrix and right side are sums over the person's ratings: they are added up per person inside
tasks first, so that somebody with very many ratings is one row a batch, then across tasks, and
solved for many people at once. Nothing is fitted anew, and nobody's result depends on who else
is folded in.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinrank.operators.norm_search import bounded_recommend
from kinrank.operators.quality import require_adhoc
from kinrank.session import written

# People whose equations are solved at once, and numbers that a task adds up at once.
AT_ONCE = 4096
CELLS_AT_ONCE = 4_000_000


@dataclass(frozen=True)
class FoldedModel:
    """A model of other people over the same products."""

    userFactors: DataFrame
    itemFactors: DataFrame
    rank: int


def _gram(model: ALSModel) -> np.ndarray:
    """The products of all product factors with themselves, which implicit equations share."""
    rank, v = model.rank, F.col("features")
    cells = [F.sum(v[i].cast("double") * v[j]) for i in range(rank) for j in range(i, rank)]
    gram = np.zeros((rank, rank))
    gram[np.triu_indices(rank)] = [x or 0.0 for x in model.itemFactors.agg(*cells).first()]
    return gram + np.triu(gram, 1).T


def _part_sums(rank: int, implicit: bool):
    """Per person and batch: upper triangle of the matrix, right side, and how many ratings count."""
    rows, columns = np.triu_indices(rank)

    def sums_of(people: np.ndarray, v: np.ndarray, rating: np.ndarray) -> pa.RecordBatch:
        if implicit:
            weight, liked = np.abs(rating), rating > 0
            target, counted = np.where(liked, 1 + weight, 0.0), liked.astype(float)
        else:
            weight, target, counted = np.ones(len(rating)), rating, np.ones(len(rating))
        ids, place = np.unique(people, return_inverse=True)
        order = np.argsort(place, kind="stable")
        starts = np.searchsorted(place[order], np.arange(len(ids)))
        whole = np.concatenate([weight[:, None] * v[:, rows] * v[:, columns], target[:, None] * v, counted[:, None]], axis=1)
        sums = np.add.reduceat(whole[order], starts, axis=0)
        lists = pa.FixedSizeListArray.from_arrays(pa.array(sums.ravel()), sums.shape[1])
        return pa.RecordBatch.from_arrays([pa.array(ids), lists.cast(pa.list_(pa.float64()))], names=["user_id", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, CELLS_AT_ONCE // (len(rows) + rank + 1))
        for batch in batches:
            v = batch.column("features").flatten().to_numpy().reshape(-1, rank).astype(np.float64)
            people, rating = batch.column("user_id").to_numpy(), batch.column("rating").to_numpy()
            for low in range(0, batch.num_rows, step):
                part = slice(low, low + step)
                yield sums_of(people[part], v[part], rating[part])

    return add


def _solved(rank: int, regularisation: float, gram: np.ndarray | None):
    """Adds up the sums of each person, who stand together, and solves their equations."""
    rows, columns = np.triu_indices(rank)

    def solve(people: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
        matrix = np.zeros((len(people), rank, rank))
        matrix[:, rows, columns] = matrix[:, columns, rows] = sums[:, : len(rows)]
        matrix[:, range(rank), range(rank)] += regularisation * sums[:, -1:]
        if gram is not None:
            matrix += gram
        right = sums[:, len(rows) : len(rows) + rank, None]
        try:
            factors = np.linalg.solve(matrix, right)[:, :, 0]
        except np.linalg.LinAlgError:
            # Without regularisation few ratings do not determine the factors: the shortest ones.
            factors = np.stack([np.linalg.lstsq(m, r[:, 0], rcond=None)[0] for m, r in zip(matrix, right, strict=True)])
        flat = pa.array(factors.astype(np.float32).ravel())
        return pa.RecordBatch.from_arrays(
            [pa.array(people, pa.int32()), pa.FixedSizeListArray.from_arrays(flat, rank).cast(pa.list_(pa.float32()))],
            names=["id", "features"],
        )

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_person, held = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = batch.column("sums").flatten().to_numpy()
            ids, sums = batch.column("user_id").to_numpy(), flat.reshape(batch.num_rows, -1)
            starts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
            people, totals = ids[starts], np.add.reduceat(sums, starts, axis=0)
            if held is not None:
                if people[0] == held_person:
                    totals[0] += held
                else:
                    people, totals = np.concatenate([[held_person], people]), np.concatenate([held[None], totals])
            # The last one may go on in the next batch.
            held_person, held = people[-1], totals[-1]
            for first in range(0, len(people) - 1, AT_ONCE):
                last = min(first + AT_ONCE, len(people) - 1)
                yield solve(people[first:last], totals[first:last])
        if held is not None:
            yield solve(np.array([held_person]), held[None])

    return rows_of


def fold_in(model: ALSModel, ratings: DataFrame, regularisation: float, implicit: bool = False) -> FoldedModel:
    """A model of the people in ``ratings`` over the products of ``model``.

    ``regularisation`` and ``implicit`` are those the model was fitted with; ``ratings`` are as for
    fitting, unique per user and product. Ratings of products the model does not know do not count;
    people without any other have no factors.
    """
    typed = ratings.select(
        F.col("user_id").cast("int").alias("user_id"),
        F.col("product_id").cast("int").alias("id"),
        F.col("rating").cast("double").alias("rating"),
    )
    rows = typed.join(model.itemFactors, "id").select("user_id", "rating", "features")
    sums = rows.mapInArrow(_part_sums(model.rank, implicit), "user_id int, sums array<double>")
    gathered = sums.repartition("user_id").sortWithinPartitions("user_id")
    gram = _gram(model) if implicit else None
    users = gathered.mapInArrow(_solved(model.rank, regularisation, gram), "id int, features array<float>")
    return FoldedModel(written(users), model.itemFactors, model.rank)


def recommend_folded(
    model: ALSModel, adhoc: DataFrame, names: DataFrame, regularisation: float, n: int = 10, **options
) -> DataFrame:
    """Recommend to people who bring their own ratings, without fitting anew.

    Marks of 0 ("not seen") are dropped; somebody without any other mark raises, and so does a mark
    outside 0 to 5. Whoever marked only products the model does not know gets nothing.
    """
    mine = require_adhoc(written(adhoc))
    folded = fold_in(model, mine, regularisation)
    return bounded_recommend(folded, mine, names, n=n, **options)
