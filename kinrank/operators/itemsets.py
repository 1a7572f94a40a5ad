"""Frequent itemsets."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from kinrank.session import ensure_checkpoint_dir


def frequent_itemsets(
    transactions: DataFrame, min_support: float = 0.3, partitions: int | None = None
) -> DataFrame:
    """Item sets in at least ``min_support`` of the transactions: ``items`` (sorted), ``freq``.

    An item repeated within a transaction counts once. The result is checkpointed: mining
    is lazy and would otherwise start over at every use, after its input left the cache.
    """
    ensure_checkpoint_dir(transactions.sparkSession)
    baskets = transactions.select(F.array_distinct("items").alias("items"))
    baskets.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        miner = FPGrowth(itemsCol="items", minSupport=min_support)
        if partitions is not None:
            miner.setNumPartitions(partitions)
        found = miner.fit(baskets).freqItemsets
        return found.select(F.array_sort("items").alias("items"), "freq").checkpoint()
    finally:
        baskets.unpersist()


def itemset_text(itemsets: DataFrame) -> DataFrame:
    """``[a,b], freq`` lines."""
    line = F.format_string("[%s], %d", F.array_join("items", ","), "freq")
    return itemsets.select(line.alias("text"))


def transaction_count(transactions: DataFrame) -> DataFrame:
    return transactions.agg(F.count("*").alias("n_transactions"))


def itemset_count(itemsets: DataFrame) -> DataFrame:
    return itemsets.agg(F.count("*").alias("n_itemsets"))
