"""Checks and summaries of rating data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinrank.functions.scores import HIGHEST_RATING, LOWEST_RATING
from kinrank.session import written


class InvalidRatingsError(ValueError):
    """Ratings out of range, or of products without a name."""


class UnknownUserError(LookupError):
    """A recommendation was asked for a user who has rated nothing."""


class NoRatingsError(ValueError):
    """Somebody brought only "not seen" marks."""


def invalid_ratings(
    ratings: DataFrame,
    names: DataFrame,
    low: float = LOWEST_RATING,
    high: float = HIGHEST_RATING,
) -> DataFrame:
    """The rows that break a rule, with the first rule broken as ``reason``.

    The bounds themselves are valid. NaN counts as above the range; a null rating is no
    rating.
    """
    known = names.select("product_id").distinct().withColumn("_known", F.lit(True))
    reason = (
        F.when(F.col("rating").isNull(), "no rating")
        .when(F.col("rating") < low, "below range")
        .when(F.col("rating") > high, "above range")
        .when(F.col("_known").isNull(), "unknown product")
    )
    return (
        ratings.join(known, "product_id", "left")
        .withColumn("reason", reason)
        .where(F.col("reason").isNotNull())
        .select(*ratings.columns, "reason")
    )


def require_valid(ratings: DataFrame, names: DataFrame, **bounds) -> DataFrame:
    """``ratings`` unchanged, or ``InvalidRatingsError``; stops at the first bad row."""
    if not invalid_ratings(ratings, names, **bounds).isEmpty():
        raise InvalidRatingsError("ratings outside the range or of products without a name")
    return ratings


def _not_seen():
    return F.col("rating") == 0


def impossible_marks(marks: DataFrame) -> DataFrame:
    """Marks of ad-hoc people that are no mark: null, NaN, below 0 or above 5."""
    rating = F.col("rating")
    possible = F.coalesce(rating.between(0, HIGHEST_RATING), F.lit(False))
    return marks.where(~possible).select("user_id", "product_id", "rating")


def clean_adhoc(ratings: DataFrame) -> DataFrame:
    """Drop the 0 = "not seen" marks of people who bring their own ratings, and only those.

    A mark that is none fails the query when it is read, wherever it turns up; use
    ``require_adhoc`` to learn of it at once, or ``impossible_marks`` to see them.
    """
    rating = F.col("rating")
    possible = F.coalesce(rating.between(0, HIGHEST_RATING), F.lit(False))
    checked = F.when(possible, rating).otherwise(
        F.raise_error(F.concat(F.lit("a mark outside 0 to 5: "), F.coalesce(rating.cast("string"), F.lit("null"))))
    )
    return (
        ratings.select("user_id", "product_id", checked.alias("rating")).where(~_not_seen())
    )


def adhoc_users_without_ratings(ratings: DataFrame) -> DataFrame:
    """People all of whose marks are dropped by ``clean_adhoc``."""
    kept = F.count_if(~_not_seen())
    return ratings.groupBy("user_id").agg(kept.alias("_kept")).where("_kept = 0").select("user_id")


def adhoc_with_ratings(ratings: DataFrame) -> DataFrame:
    """The marks, unchanged, of people who have any other than 0."""
    return ratings.join(adhoc_users_without_ratings(ratings), "user_id", "left_anti")


def require_adhoc(ratings: DataFrame) -> DataFrame:
    """Cleaned ad-hoc ratings.

    ``InvalidRatingsError`` when a mark is outside 0 to 5, ``NoRatingsError`` when somebody
    has none but 0.
    """
    if not impossible_marks(ratings).isEmpty():
        raise InvalidRatingsError("a mark outside 0 to 5")
    if not adhoc_users_without_ratings(ratings).isEmpty():
        raise NoRatingsError("somebody provided no rating")
    return clean_adhoc(ratings)


def with_adhoc(ratings: DataFrame, adhoc: DataFrame) -> DataFrame:
    """Ratings and ad-hoc ratings together; duplicates stay."""
    columns = ["user_id", "product_id", "rating"]
    return ratings.select(*columns).unionByName(adhoc.select(*columns))


def unknown_users(targets: DataFrame, ratings: DataFrame) -> DataFrame:
    """Target users who have rated nothing."""
    return targets.select("user_id").distinct().join(
        ratings.select("user_id").distinct(), "user_id", "left_anti"
    )


def known_targets(targets: DataFrame, ratings: DataFrame, on_unknown: str = "raise") -> DataFrame:
    """The distinct targets who have ratings.

    ``on_unknown='raise'`` fails with ``UnknownUserError`` if any has none, ``'drop'``
    leaves them out.
    """
    if on_unknown not in ("raise", "drop"):
        raise ValueError("on_unknown is 'raise' or 'drop'")
    if on_unknown == "raise" and not unknown_users(targets, ratings).isEmpty():
        raise UnknownUserError("a target user has no ratings")
    return targets.select("user_id").distinct().join(
        ratings.select("user_id").distinct(), "user_id", "left_semi"
    )


def users_below(ratings: DataFrame, minimum: int = 20) -> DataFrame:
    """Users with fewer than ``minimum`` ratings."""
    return (
        ratings.groupBy("user_id")
        .agg(F.count("*").alias("n_ratings"))
        .where(F.col("n_ratings") < minimum)
    )


def id_bitmaps(ratings: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Which users and products occur, as bits: ``kind, word, bits, n`` for each group of ``by``.

    ``bits`` has bit i where id ``64 * word + i`` occurs, ``n`` counts the ratings. The bitmaps of parts (a
    split, a day) merge into those of the whole with :func:`merged_bitmaps`, so distinct counts of any union
    of parts need no second look at the ratings. Words of 64 bits are added up by hash aggregation before
    anything is shuffled, and suit scattered ids, too. Ids must be whole numbers; a null id counts as a
    rating, not as a user or product.
    """
    ids = F.explode(
        F.array(
            F.struct(F.lit("user").alias("kind"), F.col("user_id").cast("bigint").alias("id")),
            F.struct(F.lit("product").alias("kind"), F.col("product_id").cast("bigint").alias("id")),
        )
    )
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("id.id").bitwiseAND(F.lit(63).cast("bigint")).cast("int"))
    return (
        ratings.select(*by, ids.alias("id"))
        .groupBy(*by, F.col("id.kind").alias("kind"), F.shiftright("id.id", 6).alias("word"))
        .agg(F.bit_or(bit).alias("bits"), F.count("*").alias("n"))
    )


def merged_bitmaps(bitmaps: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """The bitmaps of coarser groups, from those of their parts."""
    return bitmaps.groupBy(*by, "kind", "word").agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n"))


def bitmap_summary(bitmaps: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Per group: ratings, distinct users, distinct products."""

    def total(kind: str, value):
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, value)), F.lit(0)).cast("bigint")

    return bitmaps.groupBy(*by).agg(
        total("user", F.col("n")).alias("n_ratings"),
        total("user", F.bit_count("bits")).alias("n_users"),
        total("product", F.bit_count("bits")).alias("n_products"),
    )


def ratings_summary(ratings: DataFrame) -> DataFrame:
    """One row: ratings, distinct users, distinct products."""
    return bitmap_summary(id_bitmaps(ratings))


def split_summaries(split: DataFrame, column: str = "split") -> DataFrame:
    """The same for each part of a split and, under a null label, for all parts together.

    The whole is merged from the parts' bitmaps, which are made in one pass and written.
    """
    parts = written(id_bitmaps(split.select(F.col(column).alias("part"), "user_id", "product_id"), ("part",)))
    whole = bitmap_summary(merged_bitmaps(parts)).withColumn("part", F.lit(None).cast(dict(parts.dtypes)["part"]))
    return bitmap_summary(parts, ("part",)).unionByName(whole).withColumnRenamed("part", column)


def ratings_of(ratings: DataFrame, targets: DataFrame) -> DataFrame:
    """All ratings of the target users."""
    return ratings.join(targets.select("user_id").distinct(), "user_id", "left_semi")


def user_histories(
    ratings: DataFrame, targets: DataFrame | None = None, span: int = 1000
) -> DataFrame:
    """What each user rated, in arrays of bounded length.

    A history is cut at multiples of ``span`` of the product id. A pair is rated once, so
    no array holds more than ``span`` entries however much one user rates, and reading a
    user's chunks in order gives the whole history in product order.
    """
    # whole-number division in BIGINT; down, not towards zero, for negative ids
    product, size = F.col("product_id").cast("bigint"), F.lit(span).cast("bigint")
    rows = ratings.withColumn("chunk", F.call_function("div", product - F.pmod(product, size), size))
    if targets is not None:
        # shuffled again by chunk: else all rows of a user would stay where they were joined
        rows = ratings_of(rows, targets).repartition("user_id", "chunk")
    return rows.groupBy("user_id", "chunk").agg(
        F.count("*").alias("n_ratings"),
        F.sort_array(F.collect_list(F.struct("product_id", "rating"))).alias("history"),
    )
