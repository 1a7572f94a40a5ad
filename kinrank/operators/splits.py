"""Reproducible splits into training and held-out rows.

Every split labels rows in a column instead of returning several frames, so one pass can
serve all parts. Membership depends on the row's values, never on how rows are laid out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinrank.functions.scores import hash_tenth
from kinrank.operators.selection import at_or_behind, can_hunt, rows_at, with_fold
from kinrank.session import ensure_checkpoint_dir, written

TRAIN, VALID, TEST = "train", "valid", "test"

# Last digits of the timestamp that make up the training, validation and
# test parts. Digits 6 to 9 belong to none.
TRAIN_DIGITS_UP_TO = 3
VALID_DIGIT = 4
TEST_DIGIT = 5


def split_ts_digit(ratings: DataFrame) -> DataFrame:
    """Label by the last digit of ``ts_s``; unused digits get a null ``split``."""
    digit = F.col("ts_s") % 10
    return ratings.withColumn(
        "split",
        F.when(digit <= TRAIN_DIGITS_UP_TO, TRAIN)
        .when(digit == VALID_DIGIT, VALID)
        .when(digit == TEST_DIGIT, TEST),
    )


def split_hash(ratings: DataFrame, train_tenths: int = 8) -> DataFrame:
    """Label ``train_tenths`` tenths of the (user, product) pairs as training."""
    digit = hash_tenth(F.col("user_id"), F.col("product_id"))
    return ratings.withColumn("split", F.when(digit < train_tenths, TRAIN).otherwise(TEST))


def split_random(ratings: DataFrame, train_weight: float = 0.8, seed: int = 42) -> DataFrame:
    """Label by a seeded hash of the pair: any weight, again independent of layout."""
    cells = 1_000_000
    draw = F.pmod(F.xxhash64(F.lit(seed), "user_id", "product_id"), F.lit(cells))
    return ratings.withColumn(
        "split", F.when(draw < round(train_weight * cells), TRAIN).otherwise(TEST)
    )


def split_sizes(split: DataFrame, column: str = "split") -> DataFrame:
    return split.groupBy(column).agg(F.count("*").alias("n_rows"))


def with_global_index(
    rows: DataFrame, order: list[str], column: str = "idx", total: str | None = None
) -> DataFrame:
    """Number all rows 0, 1, 2, ... in a unique ``order``, without a one-task window.

    ``total`` names a column for the number of all rows.

    Rows are range-partitioned and sorted, so a row's position is the number of rows in
    the partitions before its own plus its place there. The sorted rows are checkpointed
    because both counts must see the same partition bounds.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    sorted_rows = (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_row", F.monotonically_increasing_id())
        .checkpoint()
    )
    # monotonically_increasing_id is the partition number above 33 bits of row number
    part = F.shiftright("_row", 33)
    place = F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    # one row per partition, so the windows over all of them are small
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sorted_rows.groupBy(part.alias("_part"))
        .agg(F.count("*").alias("_n"))
        .select(
            "_part",
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
            F.sum("_n").over(Window.partitionBy()).alias(total or "_total"),
        )
    )
    return (
        sorted_rows.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(column, F.col("_before") + place)
        .drop("_part", "_row", "_before", "_total")
    )


def split_kfold(ratings: DataFrame, k: int = 5, order: list[str] | None = None) -> DataFrame:
    """Label ``k`` contiguous folds of equal size, 1..k, in ``order``.

    Only the first row of each fold is looked for, see :mod:`kinrank.operators.selection`:
    ``ratings`` is read a few times, and neither sorted nor moved. An order by other columns than whole
    numbers, dates and timestamps numbers all rows instead.
    """
    order = order or ["ts_s", "user_id", "product_id"]
    if can_hunt(ratings, order):
        return with_fold(ratings, order, k)
    indexed = with_global_index(ratings, order, "_idx", "_rows")
    fold = F.call_function("div", F.col("_idx") * k, F.col("_rows")).cast("int") + 1
    return indexed.withColumn("fold", fold).drop("_idx", "_rows")


def _first_rows(rows: DataFrame, order: list[str], count: int) -> DataFrame:
    """The ``count`` first rows in a unique ``order``."""
    if not can_hunt(rows, order):
        return with_global_index(rows, order, "_idx").where(F.col("_idx") < count)
    rows = written(rows)
    total = rows.count()
    if count >= total:
        return rows
    (bound,) = rows_at(rows, order, [count], total)
    return rows.where(~at_or_behind(rows, order, bound))


def split_ordinals(
    ratings: DataFrame,
    start: int = 1,
    stop: int = 10,
    order: list[str] | None = None,
    cap: int | None = None,
) -> DataFrame:
    """Hold out each user's ``start``-th to ``stop``-th rating in ``order``.

    At most ``cap`` rows are held out overall, the first ones in ``order``; the row the cap falls on
    is looked for without sorting. The (user, product) pair must be unique. Only ``stop`` rows per user and task reach the window's
    shuffle, so a user with very many ratings does not load one task.
    """
    order = order or ["ts_s", "user_id", "product_id"]
    by_user = Window.partitionBy("user_id").orderBy(*order)
    held = (
        ratings.withColumn("_ordinal", F.row_number().over(by_user))
        .where(F.col("_ordinal") <= stop)
        .where(F.col("_ordinal") >= start)
    )
    if cap is not None:
        held = _first_rows(held, order, cap)
    held = held.select("user_id", "product_id", F.lit(TEST).alias("_held"))
    return (
        ratings.join(held, ["user_id", "product_id"], "left")
        .withColumn("split", F.coalesce("_held", F.lit(TRAIN)))
        .select(*ratings.columns, "split")
    )
