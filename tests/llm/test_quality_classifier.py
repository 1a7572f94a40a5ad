"""The quality classifier: held-out accuracy, the preference model, odd inputs."""

import random
import zlib

import numpy as np
import pytest
from helpers import clashing, docs
from pyspark.sql import functions as F

from kinrank.llm import quality
from kinrank.llm.tables import documents, table

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return quality.fit(documents(spark, FOLDER), table(spark, FOLDER, "labels"))


def test_held_out_documents(spark, model):
    labels = {r.doc_id: r.quality for r in table(spark, FOLDER, "labels").collect()}
    rows = quality.scored(documents(spark, FOLDER), model).collect()
    assert len(rows) == 1000
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    tested = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert len(tested) > 90
    assert sum(p == q for p, q in tested) / len(tested) >= 0.97


def test_only_the_text_counts(spark, model):
    frame = documents(spark, FOLDER).limit(50)
    whole = {r.doc_id: r.score for r in quality.scored(frame, model).collect()}
    other = frame.selectExpr("doc_id", "text", "'x' AS lang", "'y' AS source", "0L AS n_chars")
    assert {r.doc_id: r.score for r in quality.scored(other, model).collect()} == whole


def test_odd_documents(spark, model):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a" * 3_000_000), (5, "word " * 500_000), (6, "é🙂"), (6, "é🙂"), (None, "x")]
    found = quality.scored(clashing(docs(spark, rows)), model).collect()
    assert len(found) == 8 and all(0 <= r.score <= 1 for r in found)
    scores = {r.doc_id: r.score for r in found}
    assert scores[1] == scores[2]
    assert quality.scored(docs(spark, []), model).count() == 0


def test_filter_keeps_columns_and_what_is_good(spark, model):
    frame = clashing(documents(spark, FOLDER))
    left = quality.good_only(frame, model)
    assert left.columns == frame.columns
    good = {r.doc_id for r in quality.scored(frame, model).collect() if r.predicted}
    assert {r.doc_id for r in left.collect()} == good


def test_labels_that_teach_nothing(spark):
    frame = docs(spark, [(i, t) for i, t in enumerate(["a b", "c d", None, "e", "f g", ""])])
    schema = "doc_id bigint, quality int"
    for rows, score in (([], 1.0), ([(1, None), (None, 1)], 1.0), ([(i, 1) for i in range(6)], 1.0), ([(i, 0) for i in range(6)], 0.0)):
        model = quality.fit(frame, spark.createDataFrame(rows, schema))
        found = {r.score for r in quality.scored(frame, model).collect()}
        assert len(found) == 1 and found.pop() == pytest.approx(score, abs=1e-12)


def test_weights_solve_the_preference_model():
    rng = np.random.default_rng(1)
    good, bad = rng.normal(0.5, 1, (300, 4)), rng.normal(0, 1, (200, 4))
    model = quality.bradley_terry(good, bad, 0.25)
    g, b = ((x - model.mean) / model.scale for x in (good, bad))
    at = np.arange(300 * quality.PARTNERS)
    difference = g[at % 300] - b[(at + at // 300) % 200]
    doubt = 1 / (1 + np.exp(difference @ model.weights))
    np.testing.assert_allclose(difference.T @ doubt / len(at), quality.RIDGE * model.weights, atol=1e-6)
    # a quarter of the mass, weighted by the share of each side, lies below the threshold
    below = 0.75 * (model.scores(good) < model.threshold).mean() + 0.25 * (model.scores(bad) < model.threshold).mean()
    assert abs(below - 0.25) < 0.02


def test_long_texts_are_read_in_pieces(monkeypatch):
    draw = random.Random(1)
    data = " ".join(draw.choice(["alpha", "beta.", "GAMMA", "x\n"]) for _ in range(5000)).encode()
    whole = quality.features(data)
    monkeypatch.setattr(quality, "AT_ONCE", 12_000)
    assert b"".join(quality._pieces(data)) == data
    np.testing.assert_allclose(quality.features(data), whole, rtol=0.2, atol=0.2)


def _labelled(spark, n, bad):
    """Short documents, the labels of which their punctuation tells most of the time."""
    draw = random.Random(7)
    rows, marks = [], []
    for i in range(n):
        quality_ = int(i % 100 >= bad)
        noise = draw.random() < 0.3
        words = [draw.choice("alpha beta gamma delta 12 Epsilon".split()) for _ in range(draw.randint(1, 9))]
        rows.append((i, " ".join(words) + ("." if quality_ != noise else " |||")))
        marks.append((i, quality_))
    return docs(spark, rows), spark.createDataFrame(marks, "doc_id bigint, quality int")


@pytest.mark.parametrize("n, bad", [(26_000, 50), (1_500, 10), (1_500, 90)])
def test_all_labelled_rows_are_in_the_fit(spark, n, bad):
    frame, labels = _labelled(spark, n, bad)
    found = quality.fit(frame, labels)
    rows = frame.join(labels, "doc_id").filter(~quality.held_out()).withColumn("hash", F.xxhash64("doc_id")).collect()
    longer = max(sum(r.quality == k for r in rows) for k in (0, 1))
    rows.sort(key=lambda r: (r.hash % -(-longer // quality.NUMBERED), r.doc_id))
    good, bad = (np.array([quality.features(r.text.encode()) for r in rows if r.quality == k]) for k in (1, 0))
    expected = quality.bradley_terry(good, bad, len(bad) / len(rows))
    np.testing.assert_allclose(found.mean, expected.mean, atol=1e-9)
    np.testing.assert_allclose(found.scale, expected.scale, atol=1e-9)
    np.testing.assert_allclose(found.weights, expected.weights, atol=1e-6)
    assert found.threshold == pytest.approx(expected.threshold, abs=1e-6)


def test_rows_are_numbered_without_a_gap(spark, monkeypatch):
    monkeypatch.setattr(quality, "NUMBERED", 64)
    rows = spark.range(1000).selectExpr("id % 700 AS doc_id", "int(id % 3 > 0) AS quality", "array(double(id)) AS features")
    sizes = {r["quality"]: r["count"] for r in rows.groupBy("quality").count().collect()}
    found = quality._numbered(rows, sizes).collect()
    for k in (0, 1):
        assert sorted(r.place for r in found if r.quality == k) == list(range(sizes[k]))
    assert sorted(r.features[0] for r in found) == list(range(1000))


def test_threshold_of_many_equal_scores(spark, monkeypatch):
    monkeypatch.setattr(quality, "BUCKETS", 3)
    one = np.array([1.0])
    for values in ([0.0] * 5 + [1.0] * 45, [float(i % 7) for i in range(60)], [2.0] * 9, [i / 64 for i in range(-90, 200)]):
        rows = spark.createDataFrame([(int(i % 4 > 0), [v]) for i, v in enumerate(values)], "quality int, features array<double>")
        sides = [np.array([v for i, v in enumerate(values) if (i % 4 > 0) == k]) for k in (True, False)]
        sizes = {1: len(sides[0]), 0: len(sides[1])}
        found = quality._threshold(rows, quality.Model(one * 0, one, one, 0.0), sizes, 0.2)
        scores = np.clip(np.concatenate(sides), -6, 6)
        mass = np.concatenate([np.full(len(s), m / len(s)) for s, m in zip(sides, (0.8, 0.2), strict=True)])
        low = min(s for s in scores if mass[scores <= s].sum() >= 0.2 - 1e-12)
        assert found == (low + min(scores[scores > low], default=low)) / 2
