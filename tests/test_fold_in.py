"""People folded into a model, against solving their equations one by one."""

from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinrank.operators import fold_in as fi
from kinrank.operators.quality import InvalidRatingsError, NoRatingsError

RATED = "user_id bigint, product_id bigint, rating double"


@pytest.fixture(scope="module")
def products():
    rng = np.random.default_rng(1)
    return {p: rng.normal(size=5).astype(np.float32) for p in range(40)}


@pytest.fixture(scope="module")
def model(spark, products):
    frame = spark.createDataFrame([(p, [float(x) for x in v]) for p, v in products.items()], "id int, features array<float>")
    return SimpleNamespace(userFactors=frame.limit(0), itemFactors=frame.cache(), rank=5)


def plain(products, rows, regularisation, implicit=False):
    people = {}
    for u, p, r in rows:
        if p in products:
            people.setdefault(u, []).append((products[p].astype(float), r))
    gram = sum(np.outer(v, v) for v in map(np.float64, products.values()))
    found = {}
    for u, rated in people.items():
        if implicit:
            n = sum(r > 0 for _, r in rated)
            matrix = gram + sum(abs(r) * np.outer(v, v) for v, r in rated)
            right = sum(((1 + abs(r)) * (r > 0)) * v for v, r in rated)
        else:
            n, matrix = len(rated), sum(np.outer(v, v) for v, _ in rated)
            right = sum(r * v for v, r in rated)
        found[u] = np.linalg.solve(matrix + regularisation * n * np.eye(5), right)
    return found


def rows_of(rng, people=60):
    rows = [(u, int(p), float(rng.integers(1, 6))) for u in range(people) for p in rng.choice(45, rng.integers(1, 20), replace=False)]
    return rows + [(500, p, float(1 + p % 5)) for p in range(40)] + [(501, 44, 3.0)]


def factors(frame):
    rows = frame.collect()
    assert len(rows) == len({r.id for r in rows})
    return {r.id: np.array(r.features) for r in rows}


@pytest.mark.parametrize("implicit", [False, True])
@pytest.mark.parametrize("at_once", [1, 4096])
def test_factors_solve_the_equations(spark, model, products, implicit, at_once, monkeypatch):
    monkeypatch.setattr(fi, "AT_ONCE", at_once)
    monkeypatch.setattr(fi, "CELLS_AT_ONCE", 21 * at_once)
    rows = rows_of(np.random.default_rng(2))
    if implicit:
        rows = [(u, p, r - 2.5) for u, p, r in rows]
    frame = spark.createDataFrame(rows, RATED).repartition(5)
    got = factors(fi.fold_in(model, frame, 0.1, implicit).userFactors)
    want = plain(products, rows, 0.1, implicit)
    assert got.keys() == want.keys() and 501 not in got
    for u in want:
        assert got[u] == pytest.approx(want[u], rel=1e-3, abs=1e-4)


def test_nobody_depends_on_others(spark, model):
    rows = rows_of(np.random.default_rng(3))
    everybody = factors(fi.fold_in(model, spark.createDataFrame(rows, RATED), 0.1).userFactors)
    alone = factors(fi.fold_in(model, spark.createDataFrame([r for r in rows if r[0] == 7], RATED), 0.1).userFactors)
    assert list(alone) == [7] and alone[7] == pytest.approx(everybody[7], rel=1e-5)


def test_people_over_several_batches_are_one(spark, model, products):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        rows = rows_of(np.random.default_rng(4), 8)
        got = factors(fi.fold_in(model, spark.createDataFrame(rows, RATED).repartition(7), 0.1).userFactors)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = plain(products, rows, 0.1)
    assert got.keys() == want.keys()
    for u in want:
        assert got[u] == pytest.approx(want[u], rel=1e-3, abs=1e-4)


def test_without_regularisation_few_ratings_have_the_shortest_factors(spark, model, products):
    (row,) = fi.fold_in(model, spark.createDataFrame([(1, 3, 4.0)], RATED), 0.0).userFactors.collect()
    v = products[3].astype(float)
    assert np.array(row.features) == pytest.approx(4.0 * v / (v @ v), rel=1e-3)


def test_recommendations(spark, model, products):
    names = spark.createDataFrame([(p, f"p{p}") for p in range(3, 60)], "product_id int, name string")
    marks = [(-1, 5, 5.0), (-1, 7, 0.0), (-2, 8, 1.0), (-3, 58, 4.0)]
    found = fi.recommend_folded(model, spark.createDataFrame(marks, RATED), names, 0.1, n=4).collect()
    want = plain(products, [(u, p, r) for u, p, r in marks if r], 0.1)
    assert {r.user_id for r in found} == {-1, -2}
    for u in (-1, -2):
        own = {5} if u == -1 else {8}
        scored = sorted((-float(want[u] @ products[p]), p) for p in range(3, 40) if p not in own)
        assert [r.product_id for r in sorted(found, key=lambda r: r.pos) if r.user_id == u] == [p for _, p in scored[:4]]
    with pytest.raises(NoRatingsError):
        fi.recommend_folded(model, spark.createDataFrame([(-1, 5, 0.0)], RATED), names, 0.1)
    with pytest.raises(InvalidRatingsError):
        fi.recommend_folded(model, spark.createDataFrame([(-1, 5, 7.0)], RATED), names, 0.1)


def test_nobody(spark, model):
    assert fi.fold_in(model, spark.createDataFrame([], RATED), 0.1).userFactors.collect() == []
