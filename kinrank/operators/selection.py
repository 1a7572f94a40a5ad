"""The rows at given places of an order, and labels by place, without sorting anything.

Each place is hunted down column by column: a histogram over the range that still holds it
says which bucket it is in, and the next one divides that bucket, until few rows are left,
which come to the driver. One aggregation a round serves all places; a round leaves one row a
bucket. Rows are then labelled by comparing them with the few that were found, in one pass
that moves nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Buckets of one histogram (four at least: two share the numbers around zero), and rows that are few enough to be looked at by the driver.
BUCKETS = 4096
FEW = 2048

WHOLE = {"tinyint", "smallint", "int", "bigint", "boolean", "date", "timestamp"}

Key = tuple[int | None, ...]


def whole_number(column: Column, dtype: str) -> Column:
    """A column of integers, dates or timestamps as integers of the same order."""
    if dtype in ("tinyint", "smallint", "int", "bigint"):
        return column.cast("bigint")
    if dtype == "boolean":
        return column.cast("int").cast("bigint")
    if dtype == "date":
        return F.unix_date(column).cast("bigint")
    if dtype == "timestamp":
        return F.unix_micros(column)
    raise TypeError(f"no order by whole numbers for {dtype}")


def can_hunt(rows: DataFrame, order: Sequence[str]) -> bool:
    """Whether all columns of ``order`` have an order by whole numbers."""
    types = dict(rows.dtypes)
    return all(types[name] in WHOLE for name in order)


def _keys(rows: DataFrame, order: Sequence[str]) -> list[Column]:
    types = dict(rows.dtypes)
    return [whole_number(F.col(name), types[name]) for name in order]


@dataclass(frozen=True)
class Hunt:
    """Where a place still can be: rows that begin with ``prefix``, and go on within low to high."""

    place: int
    size: int
    prefix: Key = ()
    low: int | None = None
    high: int | None = None

    def holds(self, keys: list[Column]) -> Column:
        equal = [key.eqNullSafe(F.lit(value)) for key, value in zip(keys, self.prefix, strict=False)]
        if self.low is not None:
            key = keys[len(self.prefix)]
            equal.append(F.coalesce((key >= self.low) & (key <= self.high), F.lit(False)))
        return reduce(lambda a, b: a & b, equal, F.lit(True))

    def narrowed(self, low: int, high: int, before: int, size: int) -> Hunt:
        left = replace(self, place=self.place - before, size=size)
        if low == high:
            return replace(left, prefix=(*self.prefix, low), low=None, high=None)
        return replace(left, low=low, high=high)


def _quotient_range(quotient: int, width: int) -> tuple[int, int]:
    """The numbers that ``div width`` maps to ``quotient``; Spark's division goes towards zero."""
    if quotient > 0:
        return quotient * width, (quotient + 1) * width - 1
    if quotient < 0:
        return (quotient - 1) * width + 1, quotient * width
    return -(width - 1), width - 1


def _with_ranges(rows: DataFrame, keys: list[Column], hunts: list[Hunt]) -> list[Hunt]:
    """Least and greatest value of the column that each hunt comes to; nulls come first."""
    sums = []
    for k, hunt in enumerate(hunts):
        inside, key = hunt.holds(keys), keys[len(hunt.prefix)]
        sums += [
            F.min(F.when(inside, key)).alias(f"low{k}"),
            F.max(F.when(inside, key)).alias(f"high{k}"),
            F.count_if(inside & key.isNull()).alias(f"nulls{k}"),
        ]
    found, ranged = rows.agg(*sums).first(), []
    for k, hunt in enumerate(hunts):
        nulls = found[f"nulls{k}"]
        if hunt.place < nulls:
            ranged.append(replace(hunt, prefix=(*hunt.prefix, None), size=nulls))
        else:
            ranged.append(hunt.narrowed(found[f"low{k}"], found[f"high{k}"], nulls, hunt.size - nulls))
    return ranged


def _divided(rows: DataFrame, keys: list[Column], hunts: list[Hunt]) -> list[Hunt]:
    """Each hunt within the bucket of its range that holds its place."""
    widths = [-(-(hunt.high - hunt.low + 1) // BUCKETS) for hunt in hunts]
    cells = [
        F.when(
            hunt.holds(keys),
            F.struct(F.lit(k).alias("hunt"), F.call_function("div", keys[len(hunt.prefix)], F.lit(width).cast("bigint")).alias("bucket")),
        )
        for k, (hunt, width) in enumerate(zip(hunts, widths, strict=True))
    ]
    counted = (
        rows.select(F.explode(F.array_compact(F.array(*cells))).alias("cell"))
        .groupBy("cell.hunt", "cell.bucket")
        .agg(F.count("*").alias("n"))
        .collect()
    )
    histogram: list[list[tuple[int, int]]] = [[] for _ in hunts]
    for row in counted:
        histogram[row["hunt"]].append((row["bucket"], row["n"]))
    narrowed = []
    for hunt, width, counts in zip(hunts, widths, histogram, strict=True):
        before = 0
        for bucket, n in sorted(counts):
            if hunt.place < before + n:
                low, high = _quotient_range(bucket, width)
                narrowed.append(hunt.narrowed(max(low, hunt.low), min(high, hunt.high), before, n))
                break
            before += n
    return narrowed


def _nulls_first(key: Key) -> tuple:
    return tuple((value is not None, value or 0) for value in key)


def rows_at(rows: DataFrame, order: Sequence[str], places: Sequence[int], total: int) -> list[Key]:
    """The values of ``order``, as whole numbers, of the rows at ``places`` 0, 1, ... ``total`` - 1.

    Ascending, nulls first. ``order`` may have columns of integers, booleans, dates and timestamps.
    The driver sees ``BUCKETS`` rows a place and round, and at most ``FEW`` keys a place. ``rows`` is
    read a few times, only in the columns of ``order``.
    """
    wanted = sorted(set(places))
    if any(not 0 <= place < total for place in wanted):
        raise IndexError(f"places must be within 0 to {total - 1}")
    keys = _keys(rows, order)
    hunts = [Hunt(place, total) for place in wanted]

    def settled(hunt: Hunt) -> bool:
        return len(hunt.prefix) == len(keys) or hunt.size <= FEW

    while not all(map(settled, hunts)):
        for step, due in (
            (_with_ranges, lambda h: not settled(h) and h.low is None),
            (_divided, lambda h: not settled(h) and h.low is not None),
        ):
            chosen = [k for k, hunt in enumerate(hunts) if due(hunt)]
            if chosen:
                for k, hunt in zip(chosen, step(rows, keys, [hunts[k] for k in chosen]), strict=True):
                    hunts[k] = hunt
    open_ = [hunt for hunt in hunts if len(hunt.prefix) < len(keys)]
    few = []
    if open_:
        inside = reduce(lambda a, b: a | b, [hunt.holds(keys) for hunt in open_])
        marks = [hunt.holds(keys).alias(f"_{k}") for k, hunt in enumerate(open_)]
        few = rows.where(inside).select(*[key.alias(f"k{i}") for i, key in enumerate(keys)], *marks).collect()
    found = {}
    for hunt, place in zip(hunts, wanted, strict=True):
        if len(hunt.prefix) == len(keys):
            found[place] = hunt.prefix
        else:
            mark = len(keys) + open_.index(hunt)
            mine = sorted((tuple(row)[: len(keys)] for row in few if row[mark]), key=_nulls_first)
            found[place] = mine[hunt.place]
    return [found[place] for place in places]


def reaches(keys: list[Column], bound: Key) -> Column:
    """Whether a row stands at ``bound`` or behind it, in ascending order with nulls first."""
    found = F.lit(True)
    for key, value in reversed(list(zip(keys, bound, strict=True))):
        above = key.isNotNull() if value is None else F.coalesce(key > value, F.lit(False))
        found = above | (key.eqNullSafe(F.lit(value).cast("bigint")) & found)
    return found


def at_or_behind(rows: DataFrame, order: Sequence[str], bound: Key) -> Column:
    """The same for columns of ``rows``."""
    return reaches(_keys(rows, order), bound)


def with_fold(rows: DataFrame, order: Sequence[str], k: int, column: str = "fold") -> DataFrame:
    """Label ``k`` contiguous folds of equal size, 1..k, in ``order``; rows equal in it stay together.

    No sort and no shuffle: only the first row of each fold is looked for.
    """
    if k < 1:
        raise ValueError("there is at least one fold")
    total = rows.count()
    # A fold begins at the first place whose k-fold passes a whole number of totals.
    starts = [-(-fold * total // k) for fold in range(1, k)]
    starts = [place for place in starts if place < total]
    keys = _keys(rows, order)
    bounds = rows_at(rows, order, starts, total)
    passed = [reaches(keys, bound).cast("int") for bound in bounds]
    fold = reduce(lambda a, b: a + b, passed, F.lit(1))
    return rows.withColumn(column, fold.cast("int"))
