"""Shards under a byte limit by extendible hashing.

A directory is indexed by the first bits of a document's hash. All documents begin in one
bucket; only buckets over the limit split, on their next bit, until every bucket fits.
The bucket of a document is thus its shortest hash prefix whose documents fit. Sizes of all
prefixes come from one histogram over the longest prefixes, so each round of growing
(doubling the directory) costs one small aggregation, and texts are read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinrank.llm.tables import whole_text
from kinrank.session import written

HASH_BITS = 60
# Bits by which the directory grows when a bucket at its depth is still too large.
GROWTH = 8
LIMIT = 256 << 20


def hash_bits(key: Column) -> Column:
    """Sixty uniform bits of a key, as a non-negative bigint."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 15), 16, 10).cast("bigint")


def _prefix(depth: Column | int) -> Column:
    """The first ``depth`` bits of column ``h``."""
    return F.expr(f"shiftright(h, {HASH_BITS} - {depth})")


def shards(docs: DataFrame, limit_bytes: int = LIMIT) -> DataFrame:
    """One row per document: ``doc_id, shard, depth, shard_bytes, shard_docs, fits``.

    ``shard`` is the prefix as a string of ``depth`` bits ('' if one shard holds all).
    Sizes are bytes of the text; a null text has none. A document over the limit, or rows
    with the same id, can't be split: they end in a shard of the whole hash with ``fits``
    false. A null id hashes like an empty string. Other columns are ignored; no rows give
    no rows.
    """
    sized = written(
        docs.select(
            "doc_id",
            hash_bits(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("h"),
            F.octet_length(whole_text()).cast("bigint").alias("bytes"),
        )
    )
    buckets = _buckets(sized, limit_bytes)
    depth = buckets.agg(F.max("depth")).first()[0] or 0
    # The directory: a bucket of few bits stands in all the entries that begin with it.
    entries = buckets.withColumn(
        "entry",
        F.explode(
            F.expr(
                f"sequence(prefix * shiftleft(1L, {depth} - depth),"
                f" (prefix + 1) * shiftleft(1L, {depth} - depth) - 1)"
            )
        ),
    ) if depth <= 24 else None
    if entries is not None:
        placed = sized.withColumn("entry", _prefix(depth)).join(entries, "entry")
    else:
        # A few very deep buckets: look documents up once for each depth that occurs.
        depths = sorted(r[0] for r in buckets.select("depth").distinct().collect())
        every = F.explode(F.array(*[F.struct(F.lit(d).alias("depth"), _prefix(d).alias("prefix")) for d in depths]))
        placed = sized.withColumn("at", every).select("doc_id", "at.depth", "at.prefix").join(
            buckets, ["depth", "prefix"]
        )
    return placed.select(
        "doc_id",
        F.expr("if(depth = 0, '', lpad(bin(prefix), depth, '0'))").alias("shard"),
        "depth",
        "shard_bytes",
        "shard_docs",
        (F.col("shard_bytes") <= limit_bytes).alias("fits"),
    )


def _buckets(sized: DataFrame, limit: int) -> DataFrame:
    """The buckets that stay: ``depth, prefix, shard_bytes, shard_docs``."""
    found, base = None, 0
    rest = sized
    while True:
        depth = min(base + GROWTH, HASH_BITS)
        # All prefixes from ``base`` to ``depth`` bits, from the sizes of the longest.
        leaves = rest.groupBy(_prefix(depth).alias("leaf")).agg(
            F.sum("bytes").alias("b"), F.count("*").alias("n")
        )
        nodes = (
            leaves.withColumn("depth", F.explode(F.sequence(F.lit(base), F.lit(depth))))
            .groupBy("depth", F.expr(f"shiftright(leaf, {depth} - depth)").alias("prefix"))
            .agg(F.sum("b").alias("shard_bytes"), F.sum("n").alias("shard_docs"))
        )
        nodes = written(nodes)
        over = nodes.filter(F.col("shard_bytes") > limit)
        parents = over.select(
            (F.col("depth") + 1).alias("depth"), F.explode(F.expr("array(prefix * 2, prefix * 2 + 1)")).alias("prefix")
        )
        fitting = nodes.filter(F.col("shard_bytes") <= limit)
        # Buckets that hold after their parent had to split; the first one has no parent.
        stay = fitting.join(parents, ["depth", "prefix"], "left_semi")
        if base == 0:
            stay = stay.unionByName(fitting.filter("depth = 0"))
        if depth == HASH_BITS:
            stay = stay.unionByName(over.filter(F.col("depth") == depth))
        stay = stay.select(F.col("depth").cast("int").alias("depth"), "prefix", "shard_bytes", "shard_docs")
        found = stay if found is None else found.unionByName(stay)
        large = over.filter(F.col("depth") == depth).select(F.col("prefix").alias("leaf"))
        if depth == HASH_BITS or large.isEmpty():
            return written(found)
        rest = rest.join(large, _prefix(depth) == F.col("leaf"), "left_semi")
        base = depth
