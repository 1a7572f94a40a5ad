"""Scalar expressions over ratings and predictions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The rating scale and the point between dislike and like.
LOWEST_RATING = 0
HIGHEST_RATING = 5
IMPLICIT_MIDPOINT = 2.5

# Relative size under which a variance is rounding noise of a constant vector.
VARIANCE_NOISE = 1e-12


def implicit_shift(rating: Column) -> Column:
    """Ratings 1..5 to signed confidences -1.5..2.5."""
    return rating - F.lit(IMPLICIT_MIDPOINT)


def binary_label(confidence: Column) -> Column:
    """1.0 for a positive confidence, else 0.0."""
    return F.when(confidence > 0, F.lit(1.0)).otherwise(F.lit(0.0))


def clamp(prediction: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.greatest(F.least(prediction, F.lit(high)), F.lit(low))


def hash_tenth(user: Column, product: Column) -> Column:
    """A digit 0..9 that depends on the (user, product) pair alone.

    Splits made from it do not move when the data is laid out differently. Ids are reduced
    before they are multiplied, so that large ones do not overflow.
    """
    modulus = F.lit(1009)
    user, product = F.pmod(user.cast("bigint"), modulus), F.pmod(product.cast("bigint"), modulus)
    return F.pmod(F.pmod(user * 7919 + product * 104729, modulus), F.lit(10)).cast("int")


def block_of(key: Column, blocks: int) -> Column:
    """Spread keys evenly over ``blocks`` numbered blocks."""
    return F.pmod(F.xxhash64(key.cast("bigint")), F.lit(blocks)).cast("int")


def covariance_parts(n, sx, sy, sxx, syy, sxy):
    """n^2-scaled variances and covariance of paired values from their sums.

    Plain arithmetic, so it serves Spark columns and NumPy arrays alike.
    """
    return n * sxx - sx * sx, n * syy - sy * sy, n * sxy - sx * sy
