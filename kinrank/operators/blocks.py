"""Scoring every row of one side against every row of another, block by block.

Users (or products) are hashed into blocks of bounded size and each pair of blocks is one
cell. Spark shuffles the rows of both blocks to their cell, where matrix products do the
pairwise work, and only the best few results of each row leave the cell. So neither the
pairs nor all rows of a popular product ever form a group of their own.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Shuffled bytes of a block product that one partition should take.
PARTITION_BYTES = 128 << 20

# Products both blocks rate this densely are multiplied as matrices, the rest pair by pair.
DENSE_SHARE = 0.02
DENSE_COLUMNS = 256
PAIRS_PER_STEP = 250_000
# Users whose products of matrices are added, and who are ranked, at once: small beside the grid.
ADDED_ROWS = 256
RANKED_ROWS = 64
# Users of a cell that are multiplied with as many others at once.
TILE_USERS = 2048


def room_for(keys: int, blocks: int) -> int:
    """Users that a block has at most, but for one hashed block in very many; a grid grows where it has more.

    Rows of a grid that are never written to take no memory, so a little too much costs little.
    """
    share = keys / blocks
    return min(keys, math.ceil(share + 5 * math.sqrt(share) + 8))


@dataclass(frozen=True)
class Side:
    """Size of one side of a block product."""

    keys: int
    rows: int
    largest: int

    @classmethod
    def of(cls, ratings: DataFrame, targets: DataFrame | None = None) -> Side:
        """Distinct users, ratings, and ratings of the most active user: one row of numbers.

        Ratings are counted per user before ``targets`` choose among the users.
        """
        per_user = ratings.groupBy("user_id").agg(F.count("*").alias("n"))
        if targets is not None:
            per_user = per_user.join(targets, "user_id", "left_semi")
        found = per_user.agg(F.count("*"), F.sum("n"), F.max("n")).first()
        return cls(*(value or 0 for value in found))


def block_count(side: Side, block_keys: int, block_rows: int, wanted: int, least: int = 64) -> int:
    """Blocks that keep within ``block_keys`` keys and ``block_rows`` rows on average.

    More blocks, up to ``wanted``, are used to occupy the cores as long as a block keeps
    ``least`` keys.
    """
    needed = max(math.ceil(side.keys / block_keys), math.ceil(side.rows / block_rows), 1)
    return max(needed, min(wanted, side.keys // least))


def cell_partitions(frame: DataFrame, cells: int, size: float = 0.0) -> int:
    """Shuffle partitions for a block product of so many cells and about ``size`` bytes.

    At least four a core, because the work of cells does not show in their bytes, which is
    what adaptive execution would merge them by; more as the bytes grow.
    """
    spark = frame.sparkSession
    configured = int(spark.conf.get("spark.sql.shuffle.partitions"))
    least = max(configured, 4 * spark.sparkContext.defaultParallelism)
    return max(1, min(cells, max(least, math.ceil(size / PARTITION_BYTES))))


class Members:
    """Ids of one side of a cell, numbered as they come."""

    def __init__(self):
        self.ids = np.zeros(0, dtype=np.int64)
        self._sorted, self._order = self.ids, self.ids

    def positions(self, ids: np.ndarray) -> np.ndarray:
        """The number of each id; unseen ids get the next ones."""
        new = np.setdiff1d(ids, self._sorted)
        if len(new):
            self.ids = np.concatenate([self.ids, new])
            self._order = np.argsort(self.ids)
            self._sorted = self.ids[self._order]
        return self._order[np.searchsorted(self._sorted, ids)]


class RunningSums:
    """Co-rated sums of a cell whose products come batch by batch.

    Memory follows the users of the two blocks, not how much they rated: 48 bytes a pair. ``rows`` and
    ``columns`` are how many users either side may have; a cell that turns out larger is
    copied to a larger grid. ``grids`` such cells are kept beside each other.
    """

    def __init__(self, rows: int = 0, columns: int = 0, grids: int = 1):
        self.users, self.others = Members(), Members()
        # Zeros take no memory before they are written to.
        self.grids = np.zeros((grids, 6, rows, columns))

    @property
    def sums(self) -> np.ndarray:
        return self.grids[0]

    def place(self, user: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The users' positions in the grid, which has room for them."""
        u, v = self.users.positions(user), self.others.positions(other)
        rows, columns = len(self.users.ids), len(self.others.ids)
        had_rows, had_columns = self.grids.shape[2:]
        if rows > had_rows or columns > had_columns:
            # grown by half, so that few batches copy the sums
            grown = [n if n <= had else max(n, had * 3 // 2) for n, had in ((rows, had_rows), (columns, had_columns))]
            larger = np.zeros((*self.grids.shape[:2], max(grown[0], had_rows), max(grown[1], had_columns)))
            larger[:, :, :had_rows, :had_columns] = self.grids
            self.grids = larger
        return u, v

    def add(self, user, x, user_raters, other, y, other_raters) -> None:
        """Raters and ratings of some products, as ``corated_sums`` takes them, with ids."""
        u, v = self.place(user, other)
        corated_sums(u, x, user_raters, v, y, other_raters, sums=self.sums)

    def in_order(self, step: int = RANKED_ROWS):
        """Some users at a time: their ids, all others' ids in ascending order, and the sums of every grid."""
        order, used = np.argsort(self.others.ids), len(self.users.ids)
        for first in range(0, used, step):
            last = min(first + step, used)
            yield self.users.ids[first:last], self.others.ids[order], self.grids[:, :, first:last][..., order]


def corated_sums(u, x, u_raters, v, y, v_raters, n_users=0, n_others=0, sums=None):
    """Sums over the products two users both rated, for all pairs of two blocks of users.

    ``u`` and ``v`` are raters as positions in their block, ``x`` and ``y`` their ratings,
    product after product; ``u_raters`` and ``v_raters`` say how many belong to each
    product. Returns six (n_users, n_others) arrays: n, sum x, sum y, sum xx, sum yy,
    sum xy; or adds to ``sums`` of that shape, in the type of its numbers.
    """
    if sums is None:
        sums = np.zeros((6, n_users, n_others))
    _, n_users, n_others = sums.shape
    u_starts = np.concatenate(([0], np.cumsum(u_raters)))
    v_starts = np.concatenate(([0], np.cumsum(v_raters)))
    dense = u_raters * v_raters >= DENSE_SHARE * n_users * n_others

    columns = np.flatnonzero(dense)
    for first in range(0, len(columns), DENSE_COLUMNS):
        chosen = columns[first : first + DENSE_COLUMNS]
        x_mask, x_value = _dense(u, x, u_starts, chosen, n_users, sums.dtype)
        y_mask, y_value = _dense(v, y, v_starts, chosen, n_others, sums.dtype)
        y_square = y_value * y_value
        for low in range(0, n_users, ADDED_ROWS):
            part = slice(low, low + ADDED_ROWS)
            mask, value = x_mask[part], x_value[part]
            sums[0, part] += mask @ y_mask.T
            sums[1, part] += value @ y_mask.T
            sums[2, part] += mask @ y_value.T
            sums[3, part] += (value * value) @ y_mask.T
            sums[4, part] += mask @ y_square.T
            sums[5, part] += value @ y_value.T

    column = np.repeat(np.arange(len(u_raters)), u_raters)
    rows = np.flatnonzero(~dense[column])
    partners = v_raters[column[rows]]
    ends = np.cumsum(partners)
    flat = [part.reshape(-1) for part in sums]
    first = 0
    while first < len(rows):
        done = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, done + PAIRS_PER_STEP, side="right")))
        left = np.repeat(rows[first:last], partners[first:last])
        step = np.arange(ends[last - 1] - done) - np.repeat(
            ends[first:last] - partners[first:last] - done, partners[first:last]
        )
        right = v_starts[column[left]] + step
        cell, a, b = u[left] * n_others + v[right], x[left], y[right]
        for position, weights in enumerate((None, a, b, a * a, b * b, a * b)):
            np.add.at(flat[position], cell, 1.0 if weights is None else weights)
        first = last
    return sums


@dataclass(frozen=True)
class Tile:
    """Some users of a cell, ids ascending, and their ratings product after product.

    ``who`` are positions in ``ids``; ``products`` are numbers the cell gives, ascending, and
    ``raters`` how many of the ratings each has. ``extra`` is a column that comes with the ratings.
    """

    ids: np.ndarray
    who: np.ndarray
    rating: np.ndarray
    products: np.ndarray
    raters: np.ndarray
    extra: np.ndarray | None = None
    # The most ratings of a user, and the largest if all are whole numbers, else infinity.
    most: int = 1
    peak: float = math.inf

    def of_products(self, wanted: np.ndarray) -> Tile:
        """The same users with the ratings of the products at the positions ``wanted``."""
        if len(wanted) == len(self.products):
            return self
        chosen = np.zeros(len(self.products), dtype=bool)
        chosen[wanted] = True
        return self._kept(np.repeat(chosen, self.raters), self.products[wanted], self.raters[wanted])

    def without(self, extra: int) -> Tile:
        """The same users without the ratings whose extra is this; products may be left without raters."""
        keep = self.extra != extra
        owner = np.repeat(np.arange(len(self.products)), self.raters)
        return self._kept(keep, self.products, np.bincount(owner[keep], minlength=len(self.products)))

    def _kept(self, keep, products, raters) -> Tile:
        extra = None if self.extra is None else self.extra[keep]
        return Tile(self.ids, self.who[keep], self.rating[keep], products, raters, extra, self.most, self.peak)


def tiles_of(user, rating, product, extra=None, size: int = TILE_USERS) -> list[Tile]:
    """Ratings of a block of users, which come product after product, as tiles of ``size`` users.

    Users whose first product is the same are put side by side, so that where tastes form
    groups a tile has few products.
    """
    ids, first, who = np.unique(user, return_index=True, return_inverse=True)
    tile_of = np.empty(len(ids), dtype=np.int64)
    tile_of[np.lexsort((ids, product[first]))] = np.arange(len(ids)) // size
    rows = np.argsort(tile_of[who], kind="stable")
    found, start = [], 0
    for tile, n in enumerate(np.bincount(tile_of[who])):
        some = rows[start : start + n]
        start += n
        members = np.flatnonzero(tile_of == tile)
        products, raters = np.unique(product[some], return_counts=True)
        place, rated = np.searchsorted(members, who[some]), rating[some]
        whole = np.array_equal(rated, np.rint(rated))
        found.append(
            Tile(
                ids[members],
                place,
                rated,
                products,
                raters,
                None if extra is None else extra[some],
                int(np.bincount(place).max()),
                max(1.0, float(np.abs(rated).max())) if whole else math.inf,
            )
        )
    return found


def tile_sums(one: Tile, other: Tile, buffer: np.ndarray) -> np.ndarray | None:
    """Co-rated sums of the users of two tiles, in ``buffer``; None without a common product.

    Where whole numbers are so small that neither sums nor products of two of them are rounded,
    numbers of half the size do, and are as exact.
    """
    common, mine, theirs = np.intersect1d(one.products, other.products, assume_unique=True, return_indices=True)
    if not len(common):
        return None
    most, peak = min(one.most, other.most), max(one.peak, other.peak)
    dtype = np.float32 if most * peak < 1 << 12 else np.float64
    one, other = one.of_products(mine), other.of_products(theirs)
    shape = (6, len(one.ids), len(other.ids))
    sums = buffer.view(dtype)[: math.prod(shape)].reshape(shape)
    sums[:] = 0
    return corated_sums(one.who, one.rating, one.raters, other.who, other.rating, other.raters, sums=sums)


def tile_buffer(mine: list[Tile], theirs: list[Tile]) -> np.ndarray:
    """Room for the sums of any two tiles."""
    largest = [max((len(t.ids) for t in side), default=0) for side in (mine, theirs)]
    return np.empty(6 * math.prod(largest))


class Nearest:
    """The ``k`` best others of the users of a tile (all of them without ``k``), tile after tile."""

    def __init__(self, users: np.ndarray, k: int | None):
        self.users, self.k = users, k
        self.least = np.full(len(users), -np.inf)
        self.waiting = [(np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int32))]

    def add(self, row: np.ndarray, other: np.ndarray, score: np.ndarray, n: np.ndarray) -> None:
        """Candidates of the users at positions ``row``; undefined scores are none."""
        keep = score >= self.least[row]
        self.waiting.append((row[keep].astype(np.int32), other[keep], score[keep], n[keep].astype(np.int32)))

    @property
    def crowd(self) -> float:
        """Candidates that are worth settling before the end."""
        return math.inf if self.k is None else len(self.users) * max(1, self.k // 2)

    def raise_least(self, least: np.ndarray) -> None:
        """Scores that every user has ``k`` candidates of, at least."""
        np.maximum(self.least, least, out=self.least)

    def settle(self, crowd: float = 1) -> None:
        """Let go of what is not among the best, if a ``crowd`` was added; equals of the last may stay."""
        if sum(len(part[0]) for part in self.waiting[1:]) < crowd:
            return
        row, other, score, n = (np.concatenate(c) for c in zip(*self.waiting, strict=True))
        if self.k is not None:
            by_row, filled = self._by_row(row)
            if filled.shape[1] >= self.k and filled.size <= 4 * len(row):
                scores = np.full(filled.shape, np.inf)
                scores[filled] = -score[by_row]
                self.raise_least(-np.partition(scores, self.k - 1, axis=1)[:, self.k - 1])
                kept = np.flatnonzero(score >= self.least[row])
            else:
                kept = self._ranked(row, other, score)
            if len(kept) > 2 * self.k * len(self.users):
                kept = self._ranked(row, other, score)
            row, other, score, n = row[kept], other[kept], score[kept], n[kept]
        self.waiting = [(row, other, score, n)]

    def _by_row(self, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The order by row, and which places of a row of the longest's length are taken."""
        count = np.bincount(row, minlength=len(self.users))
        small = np.uint16 if len(self.users) < 1 << 16 else row.dtype
        return np.argsort(row.astype(small), kind="stable"), np.arange(count.max(initial=0)) < count[:, None]

    def _ranked(self, row: np.ndarray, other: np.ndarray, score: np.ndarray) -> np.ndarray:
        """The best, by row, then score, then id; ties go to the lower id."""
        by_row, filled = self._by_row(row)
        if filled.size <= 4 * len(row):
            # many short rows are sorted faster than one long list
            scores, ids = np.full(filled.shape, np.inf), np.zeros(filled.shape, dtype=np.int64)
            scores[filled], ids[filled] = -score[by_row], other[by_row]
            count = filled.sum(axis=1)
            order = by_row[np.lexsort((ids, scores))[filled] + np.repeat(np.cumsum(count) - count, count)]
        else:
            order = np.lexsort((other, -score, row))
        if self.k is None:
            return order
        sorted_row = row[order]
        place = np.arange(len(row)) - np.searchsorted(sorted_row, sorted_row)
        last = order[place == self.k - 1]
        self.least[row[last]] = np.maximum(self.least[row[last]], score[last])
        return order[place < self.k]

    def found(self) -> dict[str, np.ndarray]:
        """The best of every user, in order."""
        row, other, score, n = (np.concatenate(c) for c in zip(*self.waiting, strict=True))
        order = self._ranked(row, other, score)
        row, other, score, n = row[order], other[order], score[order], n[order]
        self.waiting = [(row, other, score, n)]
        return {"user_id": self.users[row], "neighbour_id": other, "n": n.astype(np.int64), "sim": score}


def _dense(who, rated, starts, columns, n_rows, dtype=np.float64):
    """Mask and value matrices (user x chosen product) of ratings listed by product."""
    entry = np.concatenate([np.arange(starts[c], starts[c + 1]) for c in columns])
    column = np.repeat(np.arange(len(columns)), starts[columns + 1] - starts[columns])
    mask, value = np.zeros((2, n_rows, len(columns)), dtype)
    mask[who[entry], column] = 1.0
    value[who[entry], column] = rated[entry]
    return mask, value


def best_per_row(scores: np.ndarray, k: int):
    """Row and column positions of the ``k`` highest scores of each row.

    Ties go to the lower column; NaN is never chosen.
    """
    if k < scores.shape[1]:
        # everything at least as high as the k-th value, so that ties are settled below
        limit = -np.partition(-scores, k - 1, axis=1)[:, k - 1 : k]
        wanted = (scores >= limit) | (np.isnan(limit) & ~np.isnan(scores))
    else:
        wanted = ~np.isnan(scores)
    row, column = np.nonzero(wanted)
    order = np.lexsort((column, -scores[row, column], row))
    row, column = row[order], column[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return row[place < k], column[place < k]
