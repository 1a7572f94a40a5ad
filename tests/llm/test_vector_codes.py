"""Vector codes: ball k-means against a plain program that compares everything."""

import hashlib
import math

import numpy as np
import pytest
from helpers import clashing

from kinrank.llm import vector_codes as vc

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def plain(rows):
    """Codes by comparing every part with every entry, in Python integers."""
    usable = [
        (i, [math.floor(4096 * x) for x in v], label)
        for i, v, label in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    if not usable:
        return []
    width = len(usable[0][1]) // 8
    first = sorted(usable, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:16]
    books = [[v[p * width : (p + 1) * width] for _, v, _ in first] for p in range(8)]

    def assign():
        found = []
        for _, v, _ in usable:
            codes, error = [], 0
            for p in range(8):
                part = v[p * width : (p + 1) * width]
                d = [sum((a - b) ** 2 for a, b in zip(part, e)) for e in books[p]]
                codes.append(d.index(min(d)))
                error += min(d)
            found.append((codes, error))
        return found

    for _ in range(6):
        codes = [c for c, _ in assign()]
        for p in range(8):
            for e in range(len(books[p])):
                mine = [v[p * width : (p + 1) * width] for (_, v, _), c in zip(usable, codes) if c[p] == e]
                if mine:
                    books[p][e] = [sum(x) // len(mine) for x in zip(*mine)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    done = assign()
    labels = {}
    for (_, _, label), (_, error) in zip(usable, done):
        labels[label] = labels.get(label, 0) + error
    return [
        (i, "".join(f"{c:02x}" for c in codes), error, labels[label], digest)
        for (i, _, label), (codes, error) in zip(usable, done)
    ]


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def check(spark, rows, frame=None):
    frame = frame if frame is not None else spark.createDataFrame(rows, SCHEMA)
    assert order(map(tuple, vc.vector_codes(frame).collect())) == order(plain(rows))


def test_against_plain_program(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(5, 24))
    rows = [
        (int(i), [float(x) for x in centres[i % 5] + 0.2 * rng.normal(size=24)], [None, 1, 2][i % 3]) for i in range(120)
    ]
    check(spark, rows)


def test_ties_repeats_nulls_and_clashing_columns(spark):
    # Components on a coarse grid tie all the time; ids repeat; labels are null.
    rng = np.random.default_rng(4)
    rows = [(int(i // 2), [float(x) for x in rng.integers(-1, 2, 16)], None) for i in range(60)]
    rows += [(None, rows[0][1], 3), (7, None, 1), (8, [None] * 16, 1), (9, [math.nan] * 16, 1)]
    rows += [(10, [math.inf] + [0.0] * 15, 1), rows[5], rows[5]]
    check(spark, rows)
    extra = clashing(spark.createDataFrame(rows, SCHEMA).withColumnRenamed("label", "l0")).drop("label")
    extra = extra.withColumnRenamed("l0", "label").selectExpr("*", "1 AS code", "2 AS error", "3 AS part", "4 AS length")
    check(spark, rows, extra)


def test_fewer_vectors_than_entries_and_none(spark):
    check(spark, [(5, [0.5] * 8, 1), (2, [0.25] * 8, 1)])
    assert vc.vector_codes(spark.createDataFrame([], SCHEMA)).collect() == []
    assert vc.vector_codes(spark.createDataFrame([(1, None, None)], SCHEMA)).collect() == []


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), [float(x) for x in rng.integers(-(2**16), 2**16, 8)], i % 2) for i in range(40)]
    check(spark, rows)


def test_very_large_components_and_mixed_lengths(spark):
    rows = [(1, [1e300] * 8, 1), (2, [-1e300] * 8, 1), (3, [1.0] * 8, 1), (4, [1.0] * 3, 1), (5, [], 1)]
    got = {r.vec_id: r for r in vc.vector_codes(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == 5 and got[4].error == got[5].error == 0
    assert got[1].codebooks_sha256 == got[3].codebooks_sha256 != got[4].codebooks_sha256


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_pruning_is_exact(spread):
    rng = np.random.default_rng(6)
    entries = rng.integers(-4000, 4000, (16, 8))
    own = rng.integers(0, 16, 5000)
    parts = entries[own] + (rng.normal(size=(5000, 8)) * 4000 * spread).astype(np.int64)
    best, least = vc.nearest(parts, entries, own)
    full = ((parts[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (best == full.argmin(axis=1)).all() and (least == full.min(axis=1)).all()
    # From any starting entries the result is the same.
    again, _ = vc.nearest(parts, entries, np.zeros(5000, dtype=np.int64))
    assert (again == best).all()


def test_borders_count_as_beyond():
    entries = np.array([[0], [100], [1000]])
    parts = np.array([[1], [2], [49], [50], [51], [400]])
    best, _ = vc.nearest(parts, entries, np.zeros(6, dtype=np.int64))
    assert best.tolist() == [0, 0, 0, 0, 1, 1]
    # At the same distance from both the lower index wins, from whichever side it is seen.
    best, _ = vc.nearest(parts, entries, np.ones(6, dtype=np.int64))
    assert best.tolist() == [0, 0, 0, 0, 1, 1]
