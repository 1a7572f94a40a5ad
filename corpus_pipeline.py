"""From raw documents to token ids; each stage works on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kinrank.llm import bpe, exact_dedup, mixing, near_dup, quality
from kinrank.llm.queries import VOCABULARY, WEIGHTS
from kinrank.llm.tables import table
from kinrank.session import written


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier, fitted on ``labels``, calls good."""
    return quality.good_only(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of identical texts."""
    return exact_dedup.without_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 5-word shingles at a similarity of 0.8."""
    return near_dup.without_near_copies(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Languages near their target shares of tokens: rows of scarce ones are repeated.

    The floor of 1 keeps every document at least once.
    """
    return mixing.mixed(docs, mixing.fit_mixture(docs, WEIGHTS, floor=1.0))


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded bytes, row for row."""
    import public_tokenizers

    return bpe.tokens(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", quality_filter),
    ("exact dedup", exact_copies),
    ("MinHash near-dedup", near_copies),
    ("mixing to target weights", mixture),
    ("byte-level BPE", tokenised),
]

# Models, similarity and tokens have no SQL; the tests hold every stage to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each one's rows written before the next reads them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
