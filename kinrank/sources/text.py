"""Delimited text lines to ratings, names and transactions.

Lines are split and indexed instead of read as CSV: extra fields are legal and ignored,
while a short line or a bad number must fail the job, whatever the session's ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinrank.functions.scores import implicit_shift

TAB, COLONS, PIPE = "\t", "::", "|"


def _field(line: Column, sep: str, position: int, dtype: str) -> Column:
    """Field ``position`` of a line as ``dtype``; raises when it is missing or malformed."""
    parts = F.split(line, "[|]" if sep == PIPE else sep)
    failure = F.raise_error(F.concat(F.lit("malformed line: "), line)).cast(dtype)
    return F.coalesce(F.get(parts, F.lit(position)).try_cast(dtype), failure)


def parse_ratings(
    lines: DataFrame, sep: str, keep_ts: bool = False, implicit: bool = False
) -> DataFrame:
    """``user<sep>product<sep>rating[<sep>epoch seconds...]`` lines to ratings.

    ``keep_ts`` adds the epoch seconds and their last digit; ``implicit`` shifts ratings
    to signed confidences.
    """
    line = F.col("value")
    rating = _field(line, sep, 2, "double")
    columns = [
        _field(line, sep, 0, "int").alias("user_id"),
        _field(line, sep, 1, "int").alias("product_id"),
        (implicit_shift(rating) if implicit else rating).alias("rating"),
    ]
    if keep_ts:
        seconds = _field(line, sep, 3, "bigint")
        columns += [seconds.alias("ts_s"), (seconds % 10).cast("int").alias("ts_bucket")]
    return lines.select(*columns)


def parse_names(lines: DataFrame, sep: str, order_col: str | None = None) -> DataFrame:
    """``product<sep>name...`` lines to names.

    With ``order_col`` a product listed more than once keeps its last name in that order.
    """
    line = F.col("value")
    product = _field(line, sep, 0, "int").alias("product_id")
    name = _field(line, sep, 1, "string").alias("name")
    if order_col is None:
        return lines.select(product, name)
    return keep_last_name(lines.select(product, name, F.col(order_col).alias("_order")), "_order")


def keep_last_name(names: DataFrame, order_col: str) -> DataFrame:
    """One name per product, the last one in ``order_col``."""
    return names.groupBy("product_id").agg(F.max_by("name", order_col).alias("name"))


def parse_transactions(lines: DataFrame) -> DataFrame:
    """Lines of items separated by single spaces to item arrays.

    Trailing blanks add no items, inner double blanks give an empty item, an empty line is
    one empty item and an all-blank line has no items.
    """
    line = F.col("value")
    trimmed = F.rtrim(line)
    items = (
        F.when(line == "", F.array(F.lit("")))
        .when(trimmed == "", F.array().cast("array<string>"))
        .otherwise(F.split(trimmed, " "))
    )
    return lines.select(items.alias("items"))


def read_ratings(spark: SparkSession, path: str, sep: str, **options) -> DataFrame:
    return parse_ratings(spark.read.text(path), sep, **options)


def read_names(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """Names from text files; of repeated ids the last line wins.

    Line order is the file name, then the position Spark gives the line in its split.
    """
    lines = spark.read.text(path).select(
        "value",
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("line_order"),
    )
    return parse_names(lines, sep, "line_order")


def read_transactions(spark: SparkSession, path: str) -> DataFrame:
    return parse_transactions(spark.read.text(path))
