"""The inputs of the queries, and helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def whole_text(column: str = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and whole ``text`` alone, so that no other column can clash."""
    return docs.select("doc_id", whole_text().alias("text"))
