"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kinrank.llm import (
    alignment,
    bpe,
    embedding_dedup,
    exact_dedup,
    licenses,
    main_text,
    mixing,
    near_dup,
    pii,
    quality,
    sharding,
    token_files,
    vector_codes,
)
from kinrank.llm.tables import documents, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


VOCABULARY = "byte_bpe_multi_50k.tiktoken"


@query()
def op2_byte_bpe(spark, sf_dir):
    import public_tokenizers

    return bpe.tokens(
        documents(spark, sf_dir), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN
    )


@query(
    """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""
)
def op3_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_groups(documents(spark, sf_dir))


SHARD_BYTES = 1 << 20


@query(
    f"""
WITH sized AS (
  SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h,
    strlen(coalesce(text, ''))::BIGINT AS bytes FROM documents),
prefixes AS (SELECT doc_id, bytes, d::INTEGER AS depth, h >> (60 - d)::INTEGER AS prefix
  FROM sized, generate_series(0, 60) g(d)),
sizes AS (SELECT depth, prefix, sum(bytes)::BIGINT AS shard_bytes, count(*) AS shard_docs
  FROM prefixes GROUP BY depth, prefix),
best AS (SELECT doc_id, min(depth) AS depth FROM prefixes JOIN sizes USING (depth, prefix)
  WHERE shard_bytes <= {SHARD_BYTES} OR depth = 60 GROUP BY doc_id)
SELECT doc_id,
  CASE WHEN depth = 0 THEN '' ELSE lpad(to_base(prefix, 2), depth, '0') END AS shard,
  depth, shard_bytes, shard_docs, shard_bytes <= {SHARD_BYTES} AS fits
FROM best JOIN prefixes USING (doc_id, depth) JOIN sizes USING (depth, prefix)"""
)
def op4_sharding(spark, sf_dir):
    return sharding.shards(documents(spark, sf_dir), SHARD_BYTES)


@query(licenses.oracle())
def op9_license_scan(spark, sf_dir):
    return licenses.license_matches(documents(spark, sf_dir))


@query()
def op10_minhash_near_dedup(spark, sf_dir):
    return near_dup.near_copies(documents(spark, sf_dir), width=2)


@query()
def op5_quality(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return quality.scored(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


# Shares of tokens by language.
WEIGHTS = {"en": 0.5, "fr": 0.2, "de": 0.2, "es": 0.1}


@query()
def op8_mixing(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return mixing.rates(docs, mixing.fit_mixture(docs, WEIGHTS))


@query()
def op6_embedding_near_dedup(spark, sf_dir):
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


WORDS, WORD_IDS = "word_bpe_49k.json", 49_408


@query()
def op7_token_files(spark, sf_dir):
    import public_tokenizers

    folder = token_files.token_folder(spark)
    files = token_files.write_tokens(
        documents(spark, sf_dir), folder, public_tokenizers.path(WORDS), WORD_IDS, added=True
    )
    return token_files.read_tokens(files, folder)


@query()
def op1_pii(spark, sf_dir):
    return pii.personal_data(documents(spark, sf_dir))


@query()
def op11_main_text(spark, sf_dir):
    return main_text.main_text(table(spark, sf_dir, "pages"))


@query()
def op12_tokenizer_alignment(spark, sf_dir):
    import public_tokenizers

    return alignment.alignment(
        documents(spark, sf_dir),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )


@query(vector_codes.oracle())
def op13_vector_codes(spark, sf_dir):
    return vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))
