"""Similarities of two tiles from three sums a pair instead of six, where ratings are whole numbers.

Similarity stays the same when a constant is taken from all ratings of a side; what is left of
ratings are small whole numbers, of which several sums fit into one number: of the products two users have in common
``a`` is ``syy * R + sy + n / R``, ``b`` is ``sxx * R + sx`` and ``c`` is ``sxy * R``, for a power of two ``R`` that
keeps them apart. They are exact, and so are the six sums taken out of them. A tile is multiplied and ranked some
users at a time, so that what is worked out for their pairs stays in the processor's cache.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np

from kinrank.operators.blocks import DENSE_COLUMNS, DENSE_SHARE, PAIRS_PER_STEP, Tile

# Users that are ranked with as many others at once, and of those the users who are multiplied with them at once.
RANKED_USERS = 512
ADDED_USERS = 128
# Digits that numbers of half and of full size hold.
DIGITS = {np.float32: 24, np.float64: 53}


@dataclass(frozen=True)
class Whole:
    """A tile whose ratings are less a whole number near their mean, and the most that a user's sums come to."""

    tile: Tile
    most: int
    total: float
    square: float

    @classmethod
    def of(cls, tile: Tile) -> Whole | None:
        """None without ratings, or if they are not whole numbers or so large that rounding tells in similarities."""
        if not len(tile.who) or not (tile.most * tile.peak) ** 2 < 1e12:
            return None
        rating = tile.rating - np.rint(tile.rating.mean())
        most, total, square = (np.bincount(tile.who, w).max() for w in (None, np.abs(rating), rating * rating))
        return cls(replace(tile, rating=rating), int(most), float(total), float(square))


@dataclass(frozen=True)
class Scale:
    """``R`` and the type of numbers that hold the sums of two tiles exactly."""

    base: float
    dtype: type

    @classmethod
    def of(cls, one: Whole, other: Whole) -> Scale | None:
        n, total, square = min(one.most, other.most), max(one.total, other.total), max(one.square, other.square)
        base = 2.0 ** math.ceil(math.log2(2 * (max(n, total) + 1)))
        for dtype, digits in DIGITS.items():
            # the packed sums, and the products that variances are differences of
            if max(base * (base * square + total) + n, n * square, total * total) < 2.0**digits:
                return cls(base, dtype)
        return None

    @property
    def rounding(self) -> float:
        """Added and taken away, it leaves multiples of ``R``."""
        return 1.5 * 2.0 ** (DIGITS[self.dtype] - 1) * self.base


@dataclass(frozen=True)
class Sums:
    """Some users with some others: rough similarities, NaN where undefined, and their sums a, b and c."""

    users: np.ndarray
    others: np.ndarray
    similarity: np.ndarray
    packed: np.ndarray
    base: float

    def at(self, pairs: np.ndarray) -> np.ndarray:
        """n, sx, sy, sxx, syy, sxy of pairs, given by their places row after row."""
        a, b, c = (part.reshape(-1)[pairs].astype(np.float64) for part in self.packed)
        found = np.empty((6, len(pairs)))
        n, sx, sy, sxx, syy, sxy = found
        np.rint(a / self.base, out=syy)
        a -= syy * self.base
        np.rint(a, out=sy)
        np.multiply(a - sy, self.base, out=n)
        np.rint(b / self.base, out=sxx)
        np.subtract(b, sxx * self.base, out=sx)
        np.divide(c, self.base, out=sxy)
        return found


def _matrices(tile: Tile, columns: np.ndarray, dtype) -> tuple[np.ndarray, np.ndarray]:
    """Mask and ratings (user x product) of the products at the positions ``columns``."""
    tile = tile.of_products(columns)
    place = tile.who * len(columns) + np.repeat(np.arange(len(columns)), tile.raters)
    mask, value = np.zeros((2, len(tile.ids), len(columns)), dtype)
    mask.reshape(-1)[place] = 1.0
    value.reshape(-1)[place] = tile.rating
    return mask, value


def _factors(one: Tile, other: Tile, columns: np.ndarray, scale: Scale) -> list[tuple[np.ndarray, np.ndarray]]:
    """Matrices whose products are a, b and c of these products."""
    mask, x = _matrices(one, columns, scale.dtype)
    other_mask, y = _matrices(other, columns, scale.dtype)
    base = scale.dtype(scale.base)
    return [(mask, y * y * base + y + other_mask / base), (x * x * base + x, other_mask), (x, y * base)]


def _add_rare(planes: np.ndarray, one: Tile, other: Tile, scale: Scale) -> None:
    """Adds a, b and c of products that few pairs have in common, pair by pair."""
    column = np.repeat(np.arange(len(one.products)), one.raters)
    starts = np.cumsum(other.raters) - other.raters
    partners = other.raters[column]
    ends = np.cumsum(partners)
    flat, base = [plane.reshape(-1) for plane in planes], scale.base
    first = 0
    while first < len(column):
        done = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, done + PAIRS_PER_STEP, side="right")))
        count = partners[first:last]
        left = np.repeat(np.arange(first, last), count)
        right = starts[column[left]] + np.arange(len(left)) - np.repeat(ends[first:last] - count - done, count)
        cell = one.who[left] * len(other.ids) + other.who[right]
        x, y = one.rating[left], other.rating[right]
        for plane, weight in zip(flat, (y * y * base + y + 1 / base, x * x * base + x, x * y * base), strict=True):
            np.add.at(plane, cell, weight.astype(scale.dtype))
        first = last


def _similarity(packed: np.ndarray, room: np.ndarray, similarity: np.ndarray, scale: Scale) -> None:
    """``similarity`` from a, b and c, by steps of which each fits into the processor's cache."""
    a, b, c = packed
    n, sy, syy, sx, sxx, product = room
    rounding = scale.dtype(scale.rounding)
    np.add(a, rounding, out=syy)
    syy -= rounding
    np.subtract(a, syy, out=n)
    np.rint(n, out=sy)
    n -= sy
    np.add(b, rounding, out=sxx)
    sxx -= rounding
    np.subtract(b, sxx, out=sx)
    np.multiply(c, n, out=similarity)
    np.multiply(sx, sy, out=product)
    similarity -= product
    sxx *= n
    sx *= sx
    sxx -= sx
    syy *= n
    sy *= sy
    syy -= sy
    sxx *= syy
    np.sqrt(sxx, out=sxx)
    with np.errstate(divide="ignore", invalid="ignore"):
        similarity /= sxx


def similar(one: Whole, other: Whole, scale: Scale, buffer: np.ndarray, same: bool = False) -> Iterator[tuple[int, int, Sums]]:
    """All users of two tiles, ``RANKED_USERS`` of either at a time: which parts of the tiles, and their ``Sums``.

    ``buffer`` has room for three numbers a pair. What is yielded holds until the next is asked for.
    With ``same`` the tiles are one, and every two parts meet once.
    """
    _, mine, theirs = np.intersect1d(one.tile.products, other.tile.products, assume_unique=True, return_indices=True)
    if not len(mine):
        return
    left, right = one.tile.of_products(mine), other.tile.of_products(theirs)
    rows, columns = len(left.ids), len(right.ids)
    dense = left.raters * right.raters >= DENSE_SHARE * rows * columns
    some = np.flatnonzero(dense)
    groups = [some[first : first + DENSE_COLUMNS] for first in range(0, len(some), DENSE_COLUMNS)]
    last = _factors(left, right, groups[-1], scale) if groups else None
    planes = None
    if len(groups) > 1 or not dense.all():
        planes = buffer.view(scale.dtype)[: 3 * rows * columns].reshape(3, rows, columns)
        planes[:] = 0
        rare = np.flatnonzero(~dense)
        _add_rare(planes, left.of_products(rare), right.of_products(rare), scale)
        for group in groups[:-1]:
            for plane, (x, y) in zip(planes, _factors(left, right, group, scale), strict=True):
                for low in range(0, rows, RANKED_USERS):
                    plane[low : low + RANKED_USERS] += x[low : low + RANKED_USERS] @ y.T
    shared = len(np.intersect1d(left.ids, right.ids, assume_unique=True)) > 0
    size = RANKED_USERS * RANKED_USERS
    packed, ranked = np.empty((3, size), scale.dtype), np.empty((1, size), scale.dtype)
    room = np.empty((6, ADDED_USERS * RANKED_USERS), scale.dtype)
    for i, low in enumerate(range(0, rows, RANKED_USERS)):
        for j, start in enumerate(range(0, columns, RANKED_USERS)):
            if same and j < i:
                continue
            part = slice(low, min(low + RANKED_USERS, rows)), slice(start, min(start + RANKED_USERS, columns))
            users, others = left.ids[part[0]], right.ids[part[1]]
            shape = len(users), len(others)
            sums = packed[:, : math.prod(shape)].reshape(3, *shape)
            similarity = ranked[0, : math.prod(shape)].reshape(shape)
            for first in range(0, len(users), ADDED_USERS):
                some = slice(first, min(first + ADDED_USERS, len(users)))
                these = slice(low + some.start, low + some.stop), part[1]
                if last is None:
                    sums[:, some] = planes[:, *these]
                else:
                    for out, (x, y) in zip(sums[:, some], last, strict=True):
                        np.matmul(x[these[0]], y[these[1]].T, out=out)
                    if planes is not None:
                        sums[:, some] += planes[:, *these]
                count = some.stop - some.start
                own = room[:, : count * shape[1]].reshape(6, count, shape[1])
                _similarity(sums[:, some], own, similarity[some], scale)
            if shared:
                similarity[users[:, None] == others] = np.nan
            yield i, j, Sums(users, others, similarity, sums, scale.base)
