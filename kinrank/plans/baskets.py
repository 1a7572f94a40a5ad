"""Frequent sets of brands ordered together."""

from __future__ import annotations

from pyspark.sql import functions as F

from kinrank.operators import itemsets
from kinrank.plans.registry import query
from kinrank.plans.sql import BASKETS, with_
from kinrank.sources import tables

MIN_SUPPORT = 0.005
# An order has seven lines at most, so no basket holds more brands.
LARGEST = 7


def _sets_of(size: int) -> str:
    columns = [f"b{i}.item" for i in range(size)]
    joins = "".join(
        f" JOIN basket_items AS b{i} ON b{i}.order_id = b0.order_id AND b{i}.item > b{i - 1}.item"
        for i in range(1, size)
    )
    return (
        f"SELECT {' || chr(44) || '.join(columns)} AS items, count(*) AS freq "
        f"FROM basket_items AS b0{joins} GROUP BY {', '.join(columns)}"
    )


_FREQUENT = with_(
    BASKETS,
    "\nleast AS (SELECT CAST(ceil(0.005 * count(DISTINCT order_id)) AS BIGINT) AS n "
    "FROM basket_items)",
    "\nfrequent AS (SELECT items, freq FROM ("
    + " UNION ALL ".join(_sets_of(size) for size in range(1, LARGEST + 1))
    + ") AS s, least WHERE freq >= n)",
)


def _itemsets(spark, folder):
    return itemsets.frequent_itemsets(tables.brand_baskets(spark, folder), MIN_SUPPORT)


@query(_FREQUENT + "SELECT items, freq FROM frequent")
def frequent_itemsets(spark, folder):
    found = _itemsets(spark, folder)
    return found.withColumn("items", F.array_join("items", ","))


@query(_FREQUENT + "SELECT count(*) AS n_itemsets FROM frequent")
def frequent_itemset_count(spark, folder):
    return itemsets.itemset_count(_itemsets(spark, folder))


@query(_FREQUENT + "SELECT '[' || items || '], ' || freq AS text FROM frequent")
def itemset_text(spark, folder):
    return itemsets.itemset_text(_itemsets(spark, folder))


@query(with_(BASKETS) + "SELECT count(DISTINCT order_id) AS n_transactions FROM basket_items")
def transaction_count(spark, folder):
    return itemsets.transaction_count(tables.brand_baskets(spark, folder))
