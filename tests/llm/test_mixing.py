"""Mixing: posteriors, rates that meet their targets, copies."""

import pytest
from helpers import clashing
from pyspark.sql import functions as F

from kinrank.llm import mixing
from kinrank.llm.tables import documents

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string"


@pytest.fixture(scope="module")
def corpus(spark):
    return documents(spark, FOLDER).cache()


def test_rates_meet_the_targets(spark, corpus):
    weights = {"en": 1.0, "fr": 1.0, "de": 1.0, "es": 1.0}
    mixture = mixing.fit_mixture(corpus, weights)
    rows = mixing.rates(clashing(corpus), mixture)
    assert rows.count() == corpus.count()
    total = sum(have for have, _, _ in mixture.totals.values())
    for _, target, now in mixture.totals.values():
        assert target == pytest.approx(total / 4) and abs(now - target) <= 1e-3 * total
    assert rows.where("rate < 0").isEmpty()
    # the rates are those of the steps taken one after the other on each posterior
    table = mixing._posteriors(corpus, mixture.classifier).select("tokens", "p", mixing._rate(mixture.steps, 0.0).alias("r"))
    sums = [0.0] * len(mixture.domains)
    for r in table.collect():
        assert sum(r.p) == pytest.approx(1)
        rate = 1.0
        for step in mixture.steps:
            rate = max(0.0, rate - sum(p * s for p, s in zip(r.p, step, strict=True)))
        assert r.r == pytest.approx(rate)
        sums = [s + rate * r.tokens * p for s, p in zip(sums, r.p, strict=True)]
    assert sums == pytest.approx([now for _, _, now in (mixture.totals[d] for d in mixture.domains)])


def test_domains_are_recognised(corpus):
    mixture = mixing.fit_mixture(corpus)
    found = mixing.rates(corpus, mixture).join(corpus.select("doc_id", "lang"), "doc_id")
    long = found.where("n_tokens >= 20")
    assert long.where("domain = lang").count() >= 0.97 * long.count()


def test_a_floor_keeps_every_document(corpus):
    mixture = mixing.fit_mixture(corpus, {"en": 0.5, "fr": 0.2, "de": 0.2, "es": 0.1}, floor=1.0)
    frame = clashing(corpus)
    left = mixing.mixed(frame, mixture)
    assert left.columns == frame.columns
    assert left.select("doc_id").distinct().count() == corpus.count() < left.count()
    copies = mixing.rates(corpus, mixture).agg(F.sum("copies")).first()[0]
    assert left.count() == copies


def test_copies_have_the_rate_as_their_mean(spark):
    rows = spark.range(4000).selectExpr("named_struct('doc_id', id) AS row", "1.3D AS rate")
    mean = rows.select(F.avg(mixing._copies())).first()[0]
    assert mean == pytest.approx(1.3, abs=0.03)


def test_odd_documents(spark):
    rows = [(1, "alpha beta gamma", "a"), (2, "delta epsilon", "b"), (3, None, "a"), (4, " ", None), (5, "alpha delta", None), (5, "alpha delta", None), (None, "beta", "b")]
    frame = spark.createDataFrame(rows, SCHEMA)
    mixture = mixing.fit_mixture(frame, {"a": 0.5, "b": 0.5, "none": 0.0})
    found = mixing.rates(frame, mixture).collect()
    assert len(found) == 7 and all(r.rate >= 0 and 0 <= r.posterior <= 1 for r in found)
    assert {r.n_tokens for r in found if r.doc_id in (3, 4)} == {0}
    assert mixing.mixed(frame, mixture).columns == frame.columns


def test_nothing_to_learn_from(spark):
    frame = spark.createDataFrame([(1, "a b", None)], SCHEMA)
    assert mixing.fit_mixture(frame) is None
    assert mixing.mixed(frame, None).count() == 1
    assert [(r.rate, r.n_tokens) for r in mixing.rates(frame, None).collect()] == [(1.0, 2)]
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.fit_mixture(empty) is None and mixing.rates(empty, None).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, "", "b")], SCHEMA)
    assert {r.rate for r in mixing.rates(blank, mixing.fit_mixture(blank)).collect()} == {1.0}
