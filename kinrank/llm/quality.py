"""A quality classifier from pairwise preferences (Bradley-Terry).

A document's score is linear in features of its whole text. The model says that a good
document beats a bad one with probability ``sigmoid(score difference)``; weights minimise
the logistic loss over pairs of feature differences. The threshold is the quantile of the
scores that the share of bad labels asks for; scores are shown as
``sigmoid(score - threshold)``.

Every labelled row that may be learned from is in the fit. Pairs are joined by place, each Newton
step is one pass that leaves a sum a task, and the quantile is hunted down by histograms.
"""

from __future__ import annotations

import math
import operator
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinrank.llm.tables import texts, whole_text
from kinrank.session import scratch, written

# Labelled rows of a kind that are numbered together.
NUMBERED = 1024
# Buckets of a histogram of scores.
BUCKETS = 1024
# Decimals of what is fitted: the order in which tasks add up does not show.
DECIMALS = 10
# Pairs for each row of the more frequent kind.
PARTNERS = 4
RIDGE = 1e-3
WINDOW = 256
AT_ONCE = 1 << 20

_CLASSES = np.zeros((256, 8))
for _k, _chars in enumerate(
    (
        b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
        b"0123456789",
        b".,;:'\"()",
        b"!?",
        b"|<>[]{}\\/=_~^`",
        b"#$%&*@+-",
        b"\n\r",
        b" \t",
    )
):
    _CLASSES[np.frombuffer(_chars, dtype=np.uint8), _k] = 1


def _pieces(data: bytes) -> Iterator[bytes]:
    start = 0
    while len(data) - start > AT_ONCE:
        cut = max(data.rfind(b" ", start, start + AT_ONCE), data.rfind(b"\n", start, start + AT_ONCE))
        end = cut + 1 if cut >= start else start + AT_ONCE
        yield data[start:end]
        start = end
    yield data[start:]


def features(data: bytes) -> np.ndarray:
    """Shares of character classes, word shapes, repetition in windows, and length."""
    counts = np.zeros(256)
    words = letters = upper = same = odd = ends = 0
    windows, distinct, pairs = 0, 0.0, 0.0
    lines, new_lines, sentences = 0, 0, 0
    for piece in _pieces(data):
        counts += np.bincount(np.frombuffer(piece, dtype=np.uint8), minlength=256)
        found = piece.split()
        words += len(found)
        letters += sum(map(len, found))
        upper += sum(map(bytes.isupper, found))
        same += sum(map(operator.eq, found, found[1:]))
        ends += sum(w[-1:] in b".!?" for w in found)
        odd += sum(not w[-1:].isalnum() and w[-1] < 128 and w[-1:] not in b".,;:!?" for w in found)
        for i in range(0, len(found), WINDOW):
            some = found[i : i + WINDOW]
            windows += len(some)
            distinct += len(set(some)) / len(some) ** 0.9 * len(some)
            pairs += len(set(zip(some, some[1:]))) / max(1, len(some) - 1) * len(some)
        some = [x for x in piece.split(b"\n") if x]
        lines, new_lines = lines + len(some), new_lines + len(set(some))
        some = [x for x in piece.replace(b"\n", b" ").split(b". ") if x]
        sentences += len(some)
    size, n = max(1.0, counts.sum()), max(1, words)
    shares = counts @ _CLASSES / size
    return np.array(
        [
            *np.sqrt(shares),
            np.log1p(letters / n),
            upper / n,
            np.sqrt(same / n),
            np.sqrt(ends / n),
            np.sqrt(odd / n),
            distinct / max(1, windows),
            pairs / max(1, windows),
            new_lines / max(1, lines),
            np.log1p(n / max(1, lines)),
            np.log1p(n / max(1, sentences)),
            np.log1p(words),
            np.log1p(words) ** 2,
            float(words < 5),
        ]
    )


@dataclass(frozen=True)
class Model:
    """Weights of standardised features, and the threshold of the score."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        # added up row by row: equal rows score the same whatever stands beside them
        return (np.clip((rows - self.mean) / self.scale, -6, 6) * self.weights).sum(axis=1)

    def shown(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scores(rows) - self.threshold, -500, 500)))


def _untaught(any_bad: bool, width: int) -> Model:
    """With one side empty nothing can be learned: the score is 1 where there is no bad row
    (or no row at all) and 0 where there is no good one."""
    zero = np.zeros(width)
    return Model(zero, zero + 1, zero, np.inf if any_bad else -np.inf)


def _standard(mean: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.round(mean, DECIMALS), np.round(np.where(scale < 1e-9, 1, scale), DECIMALS)


def _pull(difference: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Sums over rows of differences: their number, the gradient and the curvature of the loss."""
    p = 1 / (1 + np.exp(np.clip(difference @ weights, -500, 500)))
    curvature = (difference * (p * (1 - p))[:, None]).T @ difference
    return np.concatenate([[len(p)], difference.T @ p, curvature.ravel()])


def _newton(pull: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """The weights that minimise the loss whose sums ``pull`` gives."""
    weights = np.zeros(width)
    for _ in range(60):
        sums = pull(weights)
        mean = sums[1:] / sums[0]
        gradient = mean[:width] - RIDGE * weights
        curvature = mean[width:].reshape(width, width) + RIDGE * np.eye(width)
        step = np.linalg.solve(curvature, gradient)
        weights = weights + step * min(1.0, 2 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return np.round(weights, DECIMALS)


def bradley_terry(good: np.ndarray, bad: np.ndarray, bad_share: float) -> Model:
    """The model of two arrays of rows in memory; ``fit`` finds the same for rows of any number.

    Row ``i`` of the longer side meets ``PARTNERS`` rows of the other, spread evenly.
    """
    width = (good if len(good) else bad).shape[1] if len(good) or len(bad) else len(features(b""))
    if not len(good) or not len(bad):
        return _untaught(len(bad) > 0, width)
    both = np.concatenate([good, bad])
    mean, scale = _standard(both.mean(axis=0), both.std(axis=0))
    g, b = (np.clip((x - mean) / scale, -6, 6) for x in (good, bad))
    many, few = max(len(g), len(b)), min(len(g), len(b))
    at = np.arange(many * PARTNERS)
    of_many, of_few = at % many, (at + at // many) % few
    difference = g[of_many] - b[of_few] if len(g) >= len(b) else g[of_few] - b[of_many]
    model = Model(mean, scale, _newton(lambda weights: _pull(difference, weights), width), 0.0)
    scores = np.concatenate([model.scores(good), model.scores(bad)])
    mass = np.concatenate(
        [np.full(len(good), (1 - bad_share) / len(good)), np.full(len(bad), bad_share / len(bad))]
    )
    order = np.argsort(scores, kind="stable")
    k = int(np.searchsorted(np.cumsum(mass[order]), bad_share - 1e-12))
    found = scores[order[min(k, len(order) - 1)]]
    higher = scores[scores > found]
    return Model(mean, scale, model.weights, float((found + min(higher, default=found)) / 2))


def _with_features(frame: DataFrame) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                features(v.as_buffer().to_pybytes()).tolist()
                for v in batch.column("text").cast(pa.large_binary())
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, pa.list_(pa.float64()))], names=["doc_id", "features"]
            )

    return frame.mapInArrow(rows, f"doc_id {dict(frame.dtypes)['doc_id']}, features array<double>")


def held_out(doc_id: str = "doc_id"):
    """Rows whose labels are not learned from."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _numbered(rows: DataFrame, sizes: dict[int, int]) -> DataFrame:
    """``rows`` with a ``place`` from 0 on among those of their label: by their id's hash, then by id."""
    buckets = math.ceil(max(sizes.values()) / NUMBERED)
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)))
    earlier = Window.partitionBy("quality").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("first")
    firsts = rows.groupBy("quality", "bucket").count().select("quality", "bucket", first)
    within = F.row_number().over(Window.partitionBy("quality", "bucket").orderBy("doc_id", "features")) - 1
    placed = rows.withColumn("within", within).join(firsts, ["quality", "bucket"])
    return placed.select("quality", "features", (F.col("first") + F.col("within")).alias("place"))


def _differences(rows: DataFrame, sizes: dict[int, int], mean: np.ndarray, scale: np.ndarray) -> DataFrame:
    """The pairs of ``bradley_terry``: good less bad features, ``rows`` being numbered."""
    long = 1 if sizes[1] >= sizes[0] else 0
    many, few = sizes[long], sizes[1 - long]
    means, scales = (F.array(*map(F.lit, x.tolist())) for x in (mean, scale))

    def clipped(x, i):
        return F.greatest(F.least((x - F.get(means, i)) / F.get(scales, i), F.lit(6.0)), F.lit(-6.0))

    rows = rows.withColumn("features", F.transform("features", clipped))
    turns = F.sequence(F.lit(0), F.lit(PARTNERS - 1))
    partners = F.transform(turns, lambda turn: (F.col("place") + turn * F.lit(many + 1)) % F.lit(few))
    mine = rows.filter(F.col("quality") == long).select(F.explode(partners).alias("place"), F.col("features").alias("mine"))
    other = rows.filter(F.col("quality") == 1 - long).select("place", F.col("features").alias("other"))
    good, bad = ("mine", "other") if long else ("other", "mine")
    return mine.join(other, "place").select(F.zip_with(good, bad, lambda g, b: g - b).alias("difference"))


def _pull_of(differences: DataFrame, width: int) -> Callable[[np.ndarray], np.ndarray]:
    """``_pull`` of rows in Spark: one row of sums a task comes to the driver."""

    def pull(weights: np.ndarray) -> np.ndarray:
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(1 + width + width * width)
            for batch in batches:
                total += _pull(_matrix(batch.column("difference"), width), weights)
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()])], names=["sums"])

        return np.sum([r["sums"] for r in differences.mapInArrow(add, "sums array<double>").collect()], axis=0)

    return pull


def _threshold(rows: DataFrame, model: Model, sizes: dict[int, int], bad_share: float) -> float:
    """Halfway between the score below which the share of bad ones lies, and the next higher score.

    Each round divides the range that holds it into buckets and goes on with one of them.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = model.scores(_matrix(batch.column("features"), len(model.weights)))
            yield pa.RecordBatch.from_arrays([batch.column("quality"), pa.array(found)], names=["quality", "score"])

    scores = rows.select("quality", "features").mapInArrow(score, "quality int, score double")
    low, high = scores.agg(F.min("score"), F.max("score")).first()
    good = bad = 0
    after = None
    while low < high:
        part = (F.col("score") - low) / (high - low)
        found = (
            scores.filter(F.col("score").between(low, high))
            .groupBy(F.least(F.lit(BUCKETS - 1), F.floor(part * BUCKETS)).alias("bucket"))
            .agg(
                F.sum("quality").alias("good"),
                F.sum(1 - F.col("quality")).alias("bad"),
                F.min("score").alias("low"),
                F.max("score").alias("high"),
            )
            .collect()
        )
        found.sort(key=lambda r: r["bucket"])
        for k, r in enumerate(found):
            upto = (good + r["good"]) * (1 - bad_share) / sizes[1] + (bad + r["bad"]) * bad_share / sizes[0]
            if upto >= bad_share - 1e-12 or k + 1 == len(found):
                break
            good, bad = good + r["good"], bad + r["bad"]
        after = found[k + 1]["low"] if k + 1 < len(found) else after
        low, high = r["low"], r["high"]
    return (low + (low if after is None else after)) / 2


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from all labelled rows that are not held out. Null ids and labels teach nothing.

    Texts are turned into features where they are, labelled or not, and never shuffled. The driver
    sees counts, means, a row of sums a task, and histograms.
    """
    width = len(features(b""))
    usable = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).filter(
        F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out()
    )
    counts = {0: 0, 1: 0} | {r["quality"]: r["count"] for r in usable.groupBy("quality").count().collect()}
    if not any(counts.values()):
        return _untaught(False, width)
    bad_share = counts[0] / sum(counts.values())
    with scratch(docs.sparkSession):
        learned_from = texts(docs).filter(F.col("doc_id").isNotNull() & ~held_out())
        rows = written(_with_features(learned_from).join(usable, "doc_id"))
        sizes = {0: 0, 1: 0} | {r["quality"]: r["count"] for r in rows.groupBy("quality").count().collect()}
        if not all(sizes.values()):
            return _untaught(sizes[0] > 0, width)
        columns = [F.get("features", F.lit(i)) for i in range(width)]
        found = rows.agg(*map(F.avg, columns), *map(F.stddev_pop, columns)).first()
        mean, scale = _standard(np.array(found[:width]), np.array(found[width:]))
        rows = written(_numbered(rows, sizes))
        differences = written(_differences(rows, sizes, mean, scale))
        model = Model(mean, scale, _newton(_pull_of(differences, width), width), 0.0)
        return Model(mean, scale, model.weights, _threshold(rows, model, sizes, bad_share))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    A null text counts as empty and gets the score of an empty one. Rows that repeat an id
    are scored each for itself; other columns are never read. No rows give no rows.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("text").cast(pa.large_binary())
            found = np.array([features(v.as_buffer().to_pybytes()) for v in values])
            score = model.shown(found) if len(found) else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                names=["doc_id", "score", "predicted"],
            )

    frame = texts(docs)
    result = frame.mapInArrow(rows, f"doc_id {dict(frame.dtypes)['doc_id']}, score double, predicted int")
    return result.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def good_only(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, with all their columns, that the model calls good."""

    @F.pandas_udf("boolean")
    def good(values):
        import pandas as pd

        found = [features(v.encode()) for v in values]
        return pd.Series(model.shown(np.array(found)) >= 0.5 if found else [], dtype=bool)

    return docs.filter(good(whole_text()))
