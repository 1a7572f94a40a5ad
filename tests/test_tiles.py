"""Cells of large blocks: tiles, what is copied and shuffled, and folds."""

import numpy as np
import pytest

from kinrank.operators import blocks
from kinrank.operators import neighbours as nb


def drawn(fractional):
    rng = np.random.default_rng(3)
    product, user = np.nonzero(rng.random((20, 50)) < 0.4)
    rating = rng.integers(1, 6, len(user)) + (0.25 if fractional else 0.0)
    return 10 * user + 3, rating.astype(float), product


def plain(user, rating, product, k):
    rated = {}
    for u, r, p in zip(user, rating, product, strict=True):
        rated.setdefault(u, {})[p] = r
    found = {}
    for u, mine in rated.items():
        sums = [(v, sorted(mine.keys() & theirs.keys())) for v, theirs in rated.items() if v != u]
        parts = [np.array([[1, mine[p], rated[v][p], mine[p] ** 2, rated[v][p] ** 2, mine[p] * rated[v][p]] for p in common]).reshape(-1, 6).sum(0) for v, common in sums]
        sims = nb.pearson_array(np.array(parts).T)
        found[u] = [v for s, v in sorted((-s, v) for s, (v, _) in zip(sims, sums, strict=True) if s == s)][:k]
    return found


@pytest.mark.parametrize("fractional", [False, True])
def test_two_tiles_meet_once_for_both(fractional):
    user, rating, product = drawn(fractional)
    tiles = blocks.tiles_of(user, rating, product, size=7)
    assert len(tiles) == 8
    got = {}
    for best in nb.meet(tiles, tiles, 4, True, True, blocks.tile_buffer(tiles, tiles)):
        found = best.found()
        for u, v in zip(found["user_id"], found["neighbour_id"], strict=True):
            got.setdefault(u, []).append(v)
    assert got == plain(user, rating, product, 4)


def test_every_two_blocks_form_one_cell(frame):
    dealt = nb.with_block(nb.typed_ratings(frame([(u, u % 3, 1.0) for u in range(300)])), 6)
    cells = {(r.tb, r.ub) for r in nb.product_cells(dealt, dealt, once=True).collect()}
    assert cells == {(a, b) for a in range(6) for b in range(a, 6)}


def test_packed_ratings_are_added_up_where_their_user_is(frame):
    ratings = frame([(u, p, float(1 + (u + p) % 5)) for u in range(30) for p in range(8)])
    near = nb.user_neighbours(ratings, k=3)
    plan = nb.knn_estimate(near, ratings)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(user_id" in plan
    assert not any("Exchange hashpartitioning(user_id" in line and "product_id" in line.split("]")[0].split("),")[0] for line in plan.splitlines())


def test_unrated_pairs_are_all_returned(spark, folder):
    from kinrank.plans.registry import QUERIES
    from kinrank.sources import tables

    found = {tuple(r) for r in QUERIES["als_unrated_pairs"](spark, folder).select("user_id", "product_id").collect()}
    rated = {(r.user_id, r.product_id) for r in tables.event_ratings(spark, folder).collect()}
    products = {p for _, p in rated} & {r.product_id for r in tables.part_names(spark, folder).collect()}
    assert found == {(u, p) for u, _ in rated for p in products} - rated
