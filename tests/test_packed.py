"""Packed sums of two tiles, and the best found by them, against six sums a pair."""

import numpy as np
import pytest

from kinrank.operators import blocks
from kinrank.operators import neighbours as nb
from kinrank.operators import packed


def drawn(seed, products, users, share, highest=5):
    rng = np.random.default_rng(seed)
    product, user = np.nonzero(rng.random((products, users)) < share)
    return 3 * user - 50, rng.integers(1, highest + 1, len(user)).astype(float), product


@pytest.mark.parametrize(
    ("products", "share", "highest", "dtype"),
    [(40, 0.5, 5, np.float32), (700, 0.4, 5, np.float64), (40, 0.5, 900, np.float64), (600, 0.03, 5, np.float32), (300, np.linspace(0.01, 0.6, 300)[:, None], 5, np.float64)],
)
def test_packed_sums_are_exact(products, share, highest, dtype):
    tiles = blocks.tiles_of(*drawn(2, products, 1200, share, highest), size=700)
    one, other = tiles
    buffer = blocks.tile_buffer(tiles, tiles)
    whole = [packed.Whole.of(t) for t in tiles]
    scale = packed.Scale.of(*whole)
    assert scale.dtype is dtype
    plain = blocks.tile_sums(one, other, buffer).astype(float)
    want = nb.pearson_array(plain)
    seen = 0
    for i, j, sums in packed.similar(*whole, scale, np.empty_like(buffer)):
        rows, columns = (slice(packed.RANKED_USERS * a, packed.RANKED_USERS * (a + 1)) for a in (i, j))
        exact = sums.at(np.arange(sums.similarity.size))
        shape = sums.similarity.shape
        np.testing.assert_array_equal(exact[0].reshape(shape), plain[0, rows, columns])
        np.testing.assert_array_equal(nb.pearson_array(exact).reshape(shape), want[rows, columns])
        np.testing.assert_allclose(sums.similarity, want[rows, columns], atol=nb.ROUGH / 2)
        seen += sums.similarity.size
    assert seen == len(one.ids) * len(other.ids)


@pytest.mark.parametrize("highest", [2, 5])
@pytest.mark.parametrize("same", [True, False])
@pytest.mark.parametrize("k", [1, 25, None])
def test_the_best_are_those_of_six_sums(monkeypatch, highest, same, k):
    tiles = blocks.tiles_of(*drawn(4, 12, 1500, 0.6, highest), size=550)
    sides = (tiles, tiles) if same else (tiles[:1], tiles[1:])

    def best():
        found = {}
        for some in nb.meet(*sides, k, k is not None or same, same, blocks.tile_buffer(*sides)):
            for user, *row in zip(*some.found().values(), strict=True):
                found.setdefault(user, []).append(row)
        return found

    got = best()
    monkeypatch.setattr(nb.Whole, "of", lambda tile: None)
    assert got == best()


def test_fractions_and_large_numbers_are_not_packed():
    user, rating, product = drawn(1, 10, 20, 0.5)
    (tile,) = blocks.tiles_of(user, rating + 0.5, product)
    assert packed.Whole.of(tile) is None
    (tile,) = blocks.tiles_of(user, rating * 1e6, product)
    assert packed.Whole.of(tile) is None
    assert packed.Whole.of(blocks.tiles_of(user, rating, product)[0]) is not None


def test_the_best_stay_few_among_equals():
    best = blocks.Nearest(np.arange(3), 4)
    for first in range(0, 400, 40):
        other = np.arange(first, first + 40)[::-1]
        best.add(np.repeat(np.arange(2), 20), other, np.ones(40), np.full(40, 7))
        best.settle(best.crowd)
        assert sum(len(part[0]) for part in best.waiting) <= 2 * 4 * 3 + 40
    found = best.found()
    assert found["user_id"].tolist() == [0] * 4 + [1] * 4
    assert found["neighbour_id"].tolist() == [20, 21, 22, 23, 0, 1, 2, 3]
