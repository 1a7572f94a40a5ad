"""Embeddings against brute force: recall, counts, components and odd vectors."""

import numpy as np
import pytest

from kinrank.llm import embedding_dedup as ed

SCHEMA = "vec_id bigint, embedding array<float>"


def brute(vectors, threshold=0.9):
    ids = np.array([i for i, _ in vectors])
    rows = np.array([v for _, v in vectors], dtype=np.float32).astype(float)
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    linked = rows @ rows.T >= threshold
    np.fill_diagonal(linked, False)
    label = ids.copy()
    while True:
        low = np.minimum(label, np.where(linked, label[None, :], 2**60).min(axis=1))
        if (low == label).all():
            return {int(i): (int(n), int(c)) for i, n, c in zip(ids, linked.sum(axis=1), label, strict=True)}
        label = low


def sample(seed):
    """Vectors alone, pairs around the threshold, a large group of near copies, and copies."""
    rng = np.random.default_rng(seed)
    rows = [rng.normal(size=32) for _ in range(300)]
    for k in range(200):
        base, step = rows[k], rng.normal(size=32)
        step -= step @ base / (base @ base) * base
        cosine = rng.uniform(0.86, 0.98)
        rows.append(cosine * base / np.linalg.norm(base) + np.sqrt(1 - cosine**2) * step / np.linalg.norm(step))
    rows += [rows[0] + rng.normal(size=32) * 0.05 for _ in range(150)]
    rows += [rows[7]] * 20 + [2.5 * rows[9]] * 3
    return [(i, v.tolist()) for i, v in enumerate(rows)]


@pytest.mark.parametrize(("block", "cells"), [(16, None), (1024, None), (16, 60), (1024, 1)])
def test_links_and_components(spark, block, cells):
    vectors = sample(1)
    expected = brute(vectors)
    frame = spark.createDataFrame(vectors, SCHEMA).selectExpr("*", "1 AS id", "2 AS cell", "3 AS home", "4 AS weight")
    found = {r.vec_id: (r.n_links, r.component_id) for r in ed.near_vectors(frame, block=block, cells=cells).collect()}
    # The bound on visits is exact: no link is missing.
    assert found == expected


def test_without_a_margin_recall_falls(spark):
    vectors = sample(2)
    links = sum(n for n, _ in brute(vectors).values())
    frame = spark.createDataFrame(vectors, SCHEMA)
    narrow = sum(r.n_links for r in ed.near_vectors(frame, margin=0.0, cells=50).collect())
    wide = sum(r.n_links for r in ed.near_vectors(frame, margin=100.0, cells=50).collect())
    assert narrow <= wide == links


def pairs_at(rng, cosines, width, span=None):
    """Pairs at these cosines in ``span`` (orthonormal rows), or in all directions."""
    span = np.eye(width) if span is None else span
    rows = []
    for cosine in cosines:
        base, step = rng.normal(size=(2, len(span)))
        base /= np.linalg.norm(base)
        step -= step @ base * base
        step /= np.linalg.norm(step)
        rows += [base @ span, (cosine * base + np.sqrt(1 - cosine**2) * step) @ span]
    return rows


def all_agree(spark, rows):
    vectors = [(i, v.tolist()) for i, v in enumerate(rows)]
    expected = {}
    for width in {len(v) for _, v in vectors}:
        expected |= brute([(i, v) for i, v in vectors if len(v) == width])
    found = ed.near_vectors(spark.createDataFrame(vectors, SCHEMA))
    assert {r.vec_id: (r.n_links, r.component_id) for r in found.collect()} == expected
    assert sum(n for n, _ in expected.values()) >= len(rows) // 2


def test_a_long_vector_costs_no_links(spark):
    rng = np.random.default_rng(4)
    rows = pairs_at(rng, rng.uniform(0.901, 0.93, 1000), 64)
    all_agree(spark, [*rows, *pairs_at(rng, [0.95, 0.905], 4096)])


@pytest.mark.parametrize("rank", [4, 8])
def test_few_directions_cost_no_links(spark, rank):
    rng = np.random.default_rng(rank)
    span = np.linalg.qr(rng.normal(size=(64, rank)))[0].T
    all_agree(spark, pairs_at(rng, rng.uniform(0.901, 0.93, 1000), 64, span))


def test_odd_vectors_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]),
        (8, [None, 1.0]), (9, [1.0]), (10, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (2, [1.0, 0.0]), (11, [1e30, 0.0]),
        (12, [1e-40, 0.0]),
    ]
    found = sorted(map(tuple, ed.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    linked = {(1, 4, 1, True), (2, 4, 1, False), (11, 4, 1, False), (12, 4, 1, False)}
    assert {r for r in found if r[1]} == linked
    assert len(found) == 14 and all(r[2] == r[0] and r[3] for r in found if not r[1])


def test_no_rows(spark):
    assert ed.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    assert ed.near_vectors(spark.createDataFrame([(1, None)], SCHEMA)).count() == 1
