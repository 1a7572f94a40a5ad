"""Exact duplicates by composable polynomial fingerprints.

The fingerprint of bytes b0 b1 ... is the sum of (b_i + 1) * BASE**i, taken modulo two primes
below 2**31. Chunks are hashed on their own, all chunks of a text in one matrix product,
and chunk hashes are joined by length-shifted arithmetic: ``H(xy) = H(x) + BASE**|x| * H(y)``,
so any cut of a huge document gives the same fingerprint. Texts of equal length and
fingerprint are then compared chunk by chunk as a sorted stream; a collision therefore
splits a group instead of merging different texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinrank.llm.tables import texts
from kinrank.session import written

CHUNK = 4096
BASES = (1_000_003, 715_827_883)
MODULI = (2_147_483_647, 2_147_483_629)
# Rows of one group that one task compares.
GROUP_ROWS = 20_000

FINGERPRINT = ["n_bytes", "h1", "h2"]
_FIELDS = "n_bytes bigint, h1 bigint, h2 bigint, text_sha256 string"


class Fingerprinter:
    """Hashes bytes; ``moduli`` may be small in tests, to force collisions."""

    def __init__(self, chunk: int = CHUNK, moduli: tuple[int, int] = MODULI):
        self.chunk, self.moduli = chunk, moduli
        # Products have 9 + 31 bits, so sums of 4096 of them are exact in doubles.
        self.powers = np.array(
            [[pow(b, i, m) for b, m in zip(BASES, moduli, strict=True)] for i in range(chunk)],
            dtype=np.float64,
        )

    def chunks(self, data: bytes) -> np.ndarray:
        """One pair of hashes for every chunk of the data."""
        raw = np.frombuffer(data, dtype=np.uint8)
        whole = len(raw) // self.chunk * self.chunk
        parts = [(raw[:whole].reshape(-1, self.chunk).astype(np.float64) + 1) @ self.powers]
        if whole < len(raw):
            tail = raw[whole:].astype(np.float64) + 1
            parts.append((tail @ self.powers[: len(tail)])[None, :])
        return np.concatenate(parts).astype(np.int64) % np.array(self.moduli)

    def combine(self, left: tuple[int, int, int], right: tuple[int, int, int]):
        """The fingerprint ``(bytes, h1, h2)`` of two texts, one behind the other."""
        joined = (
            (h + pow(b, left[0], m) * g) % m
            for h, g, b, m in zip(left[1:], right[1:], BASES, self.moduli, strict=True)
        )
        return (left[0] + right[0], *joined)

    def __call__(self, data: bytes) -> tuple[int, int, int]:
        hashes = self.chunks(data)
        result = [len(data)]
        for k, (b, m) in enumerate(zip(BASES, self.moduli, strict=True)):
            shift, step, total = 1, pow(b, self.chunk, m), 0
            for h in hashes[:, k].tolist():
                total = (total + shift * h) % m
                shift = shift * step % m
            result.append(total)
        return tuple(result)


def _fingerprinted(frame: DataFrame, make: Fingerprinter, keep_text: bool) -> DataFrame:
    # Views of the Arrow buffers: no text becomes a Python string.
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text").cast(pa.large_binary())
            found, sums = [], []
            for value in column:
                data = value.as_buffer()
                found.append(make(data))
                sums.append(hashlib.sha256(data).hexdigest())
            arrays = [pa.array([f[i] for f in found], pa.int64()) for i in range(3)]
            columns = [batch.column("doc_id"), *arrays, pa.array(sums, pa.string())]
            names = ["doc_id", *FINGERPRINT, "text_sha256"]
            if keep_text:
                columns.append(batch.column("text"))
                names.append("text")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"doc_id {dict(frame.dtypes)['doc_id']}, {_FIELDS}"
    return frame.mapInArrow(rows, schema + ", text string" * keep_text)


def fingerprints(docs: DataFrame, make: Fingerprinter | None = None) -> DataFrame:
    """``doc_id``, length in bytes, both hashes and SHA-256 of every text (null: empty)."""
    return _fingerprinted(texts(docs), make or Fingerprinter(), keep_text=False)


def same_text(one: memoryview, other: memoryview, chunk: int = CHUNK) -> bool:
    """Whether two texts are identical, compared chunk by chunk up to the first difference."""
    if len(one) != len(other):
        return False
    return all(one[i : i + chunk] == other[i : i + chunk] for i in range(0, len(one), chunk))


def _compared(frame: DataFrame) -> DataFrame:
    """Each row with the SHA-256 of the first text of its group that it is identical to.

    The rows of a group come one behind the other; only the different texts of the current
    group (one, but for collisions) are held.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, leaders = None, []
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in [*FINGERPRINT, "salt"]), strict=True))
            sums = batch.column("text_sha256").to_pylist()
            labels = []
            for key, total, value in zip(keys, sums, batch.column("text").cast(pa.large_binary()), strict=True):
                data = memoryview(value.as_buffer())
                if key != group:
                    group, leaders = key, []
                label = next((name for name, text in leaders if same_text(text, data)), None)
                if label is None:
                    label = total
                    leaders.append((label, memoryview(bytes(data))))
                labels.append(label)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ["doc_id", *FINGERPRINT, "text_sha256"]] + [pa.array(labels, pa.string())],
                names=["doc_id", *FINGERPRINT, "text_sha256", "label"],
            )

    schema = f"doc_id {dict(frame.dtypes)['doc_id']}, {_FIELDS}, label string"
    return frame.mapInArrow(rows, schema)


def exact_groups(
    docs: DataFrame, make: Fingerprinter | None = None, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical; of equal ones the row with the largest ``doc_id`` stays
    (a null id sorts below all others). A null text counts as empty, so all null and empty
    texts are one group. Rows that repeat an id and its text count towards ``group_size``
    and one of them is kept. Other columns are ignored. No rows give no rows.

    Groups of more than ``group_rows`` rows are compared in several tasks; each task's
    leader carries its SHA-256, by which the parts meet again.
    """
    make = make or Fingerprinter()
    hashed = written(fingerprints(docs, make))
    sizes = hashed.groupBy(*FINGERPRINT).agg(F.count("*").alias("rows"))
    several = sizes.filter("rows > 1").withColumn(
        "salts", F.ceil(F.col("rows") / group_rows).cast("int")
    )
    candidates = (
        _fingerprinted(texts(docs), make, keep_text=True)
        .join(several.drop("rows"), FINGERPRINT)
        .withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.col("salts")).cast("int"))
        .drop("salts")
        .repartition(*FINGERPRINT, "salt")
        .sortWithinPartitions(*FINGERPRINT, "salt")
    )
    compared = written(
        _compared(candidates).withColumn("row_no", F.monotonically_increasing_id())
    )
    key = [*FINGERPRINT, "label"]
    best = compared.groupBy(*key).agg(
        F.max(F.struct("doc_id", "row_no")).alias("best"), F.count("*").alias("group_size")
    )
    copies = compared.join(best, key).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row_no") == F.col("best.row_no")).alias("kept"),
        "text_sha256",
    )
    single = hashed.join(sizes.filter("rows = 1"), FINGERPRINT, "left_semi").select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
    )
    return copies.unionByName(single)


def without_exact_copies(docs: DataFrame, make: Fingerprinter | None = None) -> DataFrame:
    """The rows of ``docs``, with all their columns, that :func:`exact_groups` keeps."""
    kept = written(exact_groups(docs, make).filter("kept").select("doc_id", "text_sha256"))
    total = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
    sha = "text_sha256"
    while sha in docs.columns:
        sha = f"_{sha}"
    right = kept.select(F.col("doc_id").alias("_kept_id"), F.col("text_sha256").alias("_kept_sha"))
    tagged = docs.withColumn(sha, total)
    found = tagged.join(
        right,
        tagged["doc_id"].eqNullSafe(right["_kept_id"]) & (tagged[sha] == right["_kept_sha"]),
        "left_semi",
    )
    # The same rows again: no further exchange, as the join has dealt by these columns.
    return found.dropDuplicates(["doc_id", sha]).drop(sha)
