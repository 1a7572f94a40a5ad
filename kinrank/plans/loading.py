"""Parsing: lines are written from the tables and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from kinrank.plans.registry import query
from kinrank.plans.sql import BASKETS, RATINGS, with_
from kinrank.sources import tables
from kinrank.sources.text import (
    COLONS,
    PIPE,
    TAB,
    parse_names,
    parse_ratings,
    parse_transactions,
)


def _rating_lines(spark, folder, sep):
    columns = ("user_id", "product_id", "rating", "ts_s")
    return tables.event_ratings(spark, folder).select(
        F.concat_ws(sep, *(F.col(c).cast("string") for c in columns)).alias("value")
    )


_TRIPLES = (
    with_(RATINGS)
    + "SELECT CAST(user_id AS INTEGER) AS user_id, product_id, CAST(rating AS DOUBLE) AS rating"
)


@query(_TRIPLES + " FROM ratings")
def parse_ratings_tab(spark, folder):
    return parse_ratings(_rating_lines(spark, folder, TAB), TAB)


@query(_TRIPLES + " FROM ratings")
def parse_ratings_colons(spark, folder):
    return parse_ratings(_rating_lines(spark, folder, COLONS), COLONS)


@query(_TRIPLES + ", ts_s, CAST(ts_s % 10 AS INTEGER) AS ts_bucket FROM ratings")
def parse_ratings_ts_bucket(spark, folder):
    return parse_ratings(_rating_lines(spark, folder, COLONS), COLONS, keep_ts=True)


@query(
    with_(RATINGS)
    + """SELECT CAST(user_id AS INTEGER) AS user_id, product_id,
  CAST(rating AS DOUBLE) - CAST(2.5 AS DOUBLE) AS rating FROM ratings"""
)
def parse_ratings_implicit(spark, folder):
    return parse_ratings(_rating_lines(spark, folder, COLONS), COLONS, implicit=True)


def _name_lines(spark, folder, sep):
    fields = ("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    return tables.table(spark, folder, "part").select(
        F.concat_ws(sep, *(F.col(c).cast("string") for c in fields)).alias("value")
    )


_NAMES = "SELECT CAST(p_partkey AS INTEGER) AS product_id, p_name AS name FROM part"


@query(_NAMES)
def parse_names_pipe(spark, folder):
    return parse_names(_name_lines(spark, folder, PIPE), PIPE)


@query(_NAMES)
def parse_names_colons(spark, folder):
    return parse_names(_name_lines(spark, folder, COLONS), COLONS)


@query(
    """SELECT product_id, name FROM (
  SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) AS product_id,
         event_type || ' ' || event_id AS name,
         row_number() OVER (PARTITION BY CAST(json_extract_string(props, '$.k') AS INTEGER)
                            ORDER BY event_id DESC) AS latest
  FROM events) AS e WHERE latest = 1"""
)
def product_names_dedup(spark, folder):
    """Every event names its product; the last event wins."""
    name = F.concat_ws(" ", "event_type", F.col("event_id").cast("string"))
    lines = tables.table(spark, folder, "events").select(
        "event_id",
        F.concat_ws(COLONS, tables.event_product().cast("string"), name).alias("value"),
    )
    return parse_names(lines, COLONS, order_col="event_id")


@query(
    with_(BASKETS)
    + """SELECT string_agg(item, '|' ORDER BY item) AS items, CAST(count(*) AS INTEGER) AS n_items
FROM basket_items GROUP BY order_id"""
)
def parse_transactions_(spark, folder):
    lines = tables.brand_baskets(spark, folder).select(
        F.array_join(F.array_sort("items"), " ").alias("value")
    )
    return parse_transactions(lines).select(
        F.array_join("items", "|").alias("items"), F.size("items").alias("n_items")
    )
