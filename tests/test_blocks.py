"""The block kernels against plain loops."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from kinrank.operators import blocks
from kinrank.operators.blocks import Side, best_per_row, block_count, corated_sums

ratings = st.dictionaries(
    st.tuples(st.integers(0, 6), st.integers(0, 9)), st.integers(1, 5), max_size=40
)


def _by_product(left, right):
    """Raters of the shared products, product after product."""
    shared = sorted({p for _, p in left} & {p for _, p in right})
    sides = []
    for rated in (left, right):
        entries = [(u, rated[u, p]) for p in shared for u in range(7) if (u, p) in rated]
        counts = [sum((u, p) in rated for u in range(7)) for p in shared]
        who = np.array([u for u, _ in entries], dtype="int64")
        sides += [who, np.array([float(r) for _, r in entries]), np.array(counts, dtype="int64")]
    return sides


def _loops(left, right):
    sums = np.zeros((6, 7, 7))
    for (u, p), x in left.items():
        for (v, q), y in right.items():
            if p == q:
                sums[:, u, v] += (1, x, y, x * x, y * y, x * y)
    return sums


@settings(max_examples=60, deadline=None)
@given(ratings, ratings, st.sampled_from([0.0, 0.05, 2.0]), st.sampled_from([1, 3, 1000]))
def test_corated_sums(left, right, dense_share, step):
    before = blocks.DENSE_SHARE, blocks.PAIRS_PER_STEP, blocks.DENSE_COLUMNS
    blocks.DENSE_SHARE, blocks.PAIRS_PER_STEP, blocks.DENSE_COLUMNS = dense_share, step, 3
    try:
        found = corated_sums(*_by_product(left, right), 7, 7)
    finally:
        blocks.DENSE_SHARE, blocks.PAIRS_PER_STEP, blocks.DENSE_COLUMNS = before
    np.testing.assert_array_equal(found, _loops(left, right))


scores = st.lists(
    st.lists(st.sampled_from([1.0, 0.5, 0.0, -1.0, float("nan")]), min_size=6, max_size=6),
    min_size=1,
    max_size=5,
)


@settings(max_examples=100, deadline=None)
@given(scores, st.integers(1, 8))
def test_best_per_row(rows, k):
    expected = [
        (i, j)
        for i, row in enumerate(rows)
        for _, j in sorted((-x, j) for j, x in enumerate(row) if x == x)[:k]
    ]
    row, column = best_per_row(np.array(rows), k)
    assert list(zip(row.tolist(), column.tolist(), strict=True)) == expected


def test_block_count():
    assert block_count(Side(0, 0, 0), 10, 100, 4) == 1
    assert block_count(Side(95, 95, 5), 10, 100, 1) == 10  # keys decide
    assert block_count(Side(20, 1000, 50), 100, 100, 1) == 10  # rows decide
    assert block_count(Side(1000, 1000, 5), 1000, 10_000, 8) == 8  # cores decide
    assert block_count(Side(130, 130, 5), 1000, 10_000, 8) == 2  # but blocks stay worth it
