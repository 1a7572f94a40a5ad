"""Rating, name and basket data derived from the star-schema tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970 of a timestamp without time zone, in any session zone."""
    day = F.unix_date(F.to_date(ts)).cast("bigint")
    return day * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def event_product() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def event_ratings(spark: SparkSession, folder: str) -> DataFrame:
    """Ratings 1..5 from events, the latest per (user, product)."""
    latest = F.max(F.struct("ts", "event_id", "value")).alias("latest")
    return (
        table(spark, folder, "events")
        .groupBy("user_id", event_product().alias("product_id"))
        .agg(latest)
        .select(
            "user_id",
            "product_id",
            F.least(F.lit(5), 1 + F.floor(F.col("latest.value") / 25).cast("int")).alias("rating"),
            epoch_seconds(F.col("latest.ts")).alias("ts_s"),
        )
    )


def raw_event_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Unchecked scores, some of them below 0 or above 5, one per event."""
    return table(spark, folder, "events").select(
        "event_id",
        "user_id",
        event_product().alias("product_id"),
        (F.floor(F.col("value") / 25).cast("int") - 1).alias("rating"),
    )


def signup_marks(spark: SparkSession, folder: str, daily: bool = False) -> DataFrame:
    """Marks 0..5 people bring along at signup, under negative ids; 0 is "not seen".

    A person is a user, or with ``daily`` a user on one day.
    """
    person = F.col("user_id").cast("bigint")
    if daily:
        person = person * 100_000 + F.unix_date(F.to_date("ts")).cast("bigint")
    else:
        person = F.col("user_id")
    return (
        table(spark, folder, "events")
        .where(F.col("event_type") == "signup")
        .groupBy((-1 - person).alias("user_id"), event_product().alias("product_id"))
        .agg(F.max(F.least(F.lit(5), F.floor(F.col("value") / 25).cast("int"))).alias("rating"))
    )


def order_ratings(spark: SparkSession, folder: str) -> DataFrame:
    """Ratings 1..5 of suppliers by customers, from the mean quantity ordered."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(
            F.col("o_custkey").cast("int").alias("user_id"),
            F.col("l_suppkey").cast("int").alias("product_id"),
        )
        .agg((1 + F.floor((F.avg("l_quantity") - 1) / 10)).cast("int").alias("rating"))
    )


def part_names(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").cast("int").alias("product_id"), F.col("p_name").alias("name")
    )


def supplier_names(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").select(
        F.col("s_suppkey").cast("int").alias("product_id"), F.col("s_name").alias("name")
    )


def nation_names(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("product_id"), F.col("n_name").alias("name")
    )


def brand_baskets(spark: SparkSession, folder: str) -> DataFrame:
    """The distinct brands of each order."""
    parts = table(spark, folder, "part").select("p_partkey", "p_brand")
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
    return (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(F.col("l_orderkey").alias("order_id"))
        .agg(F.collect_set("p_brand").alias("items"))
    )
