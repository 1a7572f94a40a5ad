"""Codes of vectors by parts, with codebooks fitted by ball k-means in integers.

A vector is cut into ``PARTS`` consecutive parts, and each part is written as the index of the
nearest of ``ENTRIES`` entries of that part's codebook. Parts keep their entry from round
to round. The parts of one entry form a ball: with the distance of its farthest part, the
ball's radius, only entries whose own distance from it is at most twice the radius are
neighbours. A part that is nearer to its entry than half the way to the nearest neighbour is
in the stable core and is done; the others lie in rings between half the ways to one
neighbour and to the next, and are compared with the neighbours up to their ring alone. All
of it is exact: sums and distances are integers, and a part on a border counts as beyond it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinrank.session import forget, written

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
# Scaled components beyond this magnitude count as this magnitude.
LARGEST = 1 << 60
# Rows worked on at once.
AT_ONCE = 4096

Codebooks = dict[int, list[np.ndarray]]


def cuts(length: int) -> list[tuple[int, int]]:
    """Where the parts of a vector begin and end; equal ones where the length allows."""
    return [(p * length // PARTS, (p + 1) * length // PARTS) for p in range(PARTS)]


def _integers(flat: np.ndarray) -> np.ndarray:
    scaled = np.floor(flat.astype(np.float64) * SCALE)
    return np.clip(scaled, -float(LARGEST), float(LARGEST)).astype(np.int64)


def _arithmetic(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as machine integers where no squared distance can overflow, else as Python's."""
    peak = max([int(np.abs(a).max()) for a in (parts, entries) if a.size] or [0])
    if 16 * peak * peak * max(1, parts.shape[1]) < 1 << 63:
        return parts.astype(np.int64), entries.astype(np.int64)
    return parts.astype(object), entries.astype(object)


def nearest(parts: np.ndarray, entries: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each part, ties to the lower index, and the squared distance.

    ``own`` is the entry that each part belonged to before; any will do, a good one saves
    comparisons.
    """
    parts, entries = _arithmetic(parts, entries)
    best = own.astype(np.int64)
    least = ((parts - entries[best]) ** 2).sum(axis=1)
    between = ((entries[:, None] - entries[None]) ** 2).sum(axis=2)
    rings, order = np.zeros(len(parts), dtype=np.int64), np.zeros((len(entries), len(entries)), dtype=np.int64)
    for ball in range(len(entries)):
        members = np.flatnonzero(own == ball)
        if not len(members):
            continue
        others = np.array([k for k in np.argsort(between[ball], kind="stable") if k != ball], dtype=np.int64)
        far = between[ball][others]
        # Squares: an entry is out of reach if its distance is over twice the part's.
        neighbours = int(np.searchsorted(far, 4 * least[members].max(), side="right"))
        order[ball, :neighbours] = others[:neighbours]
        rings[members] = np.searchsorted(far[:neighbours], 4 * least[members], side="right")
    for k in range(int(rings.max(initial=0))):
        rows = np.flatnonzero(rings > k)
        entry = order[own[rows], k]
        distance = ((parts[rows] - entries[entry]) ** 2).sum(axis=1)
        nearer = (distance < least[rows]) | ((distance == least[rows]) & (entry < best[rows]))
        best[rows[nearer]], least[rows[nearer]] = entry[nearer], distance[nearer]
    return best, least


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of vectors the rows that have it and their scaled components."""
    for start in range(0, batch.num_rows, AT_ONCE):
        column = batch.column("embedding").slice(start, AT_ONCE)
        offsets = column.offsets.to_numpy()
        flat = _integers(column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]])
        lengths, starts = np.diff(offsets), offsets[:-1] - offsets[0]
        for length in np.unique(lengths):
            rows = np.flatnonzero(lengths == length)
            yield start + rows, flat[starts[rows, None] + np.arange(length)]


def _codes(batch: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("code").to_pylist()), dtype=np.uint8).reshape(-1, PARTS)


def _assigned(batch: pa.RecordBatch, books: Codebooks) -> tuple[np.ndarray, list[int]]:
    """New codes of a batch, and the squared distances summed over parts."""
    codes, errors = _codes(batch).copy(), [0] * batch.num_rows
    for rows, matrix in _matrices(batch):
        total = 0
        for p, (low, high) in enumerate(cuts(matrix.shape[1])):
            found, distance = nearest(matrix[:, low:high], books[matrix.shape[1]][p], codes[rows, p])
            codes[rows, p] = found
            total = total + distance.astype(object)
        for row, error in zip(rows, total, strict=True):
            errors[row] = error
    return codes, errors


def _reassigned(rows: DataFrame, books: Codebooks) -> DataFrame:
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, _ = _assigned(batch, books)
            place = batch.schema.get_field_index("code")
            yield batch.set_column(place, "code", pa.array([c.tobytes() for c in codes], pa.binary()))

    return rows.mapInArrow(assign, rows.schema)


def _sums(rows: DataFrame) -> DataFrame:
    """For each length, part, entry and position the sum over the entry's parts, and how many."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int, int], list] = {}
        for batch in batches:
            all_codes = _codes(batch)
            for found, matrix in _matrices(batch):
                # Sums of so many rows at once stay below 2**63 unless components are huge.
                peak = int(np.abs(matrix).max(initial=0))
                matrix = matrix if peak * len(matrix) < 1 << 62 else matrix.astype(object)
                for p, (low, high) in enumerate(cuts(matrix.shape[1])):
                    codes = all_codes[found, p]
                    for entry in np.unique(codes):
                        mine = codes == entry
                        sums = matrix[mine, low:high].sum(axis=0).astype(object)
                        held = totals.setdefault((matrix.shape[1], p, int(entry)), [0, 0])
                        held[0], held[1] = held[0] + sums, held[1] + int(mine.sum())
        for (length, p, entry), (sums, count) in totals.items():
            yield pa.RecordBatch.from_pydict(
                {
                    "length": pa.array([length] * len(sums), pa.int32()),
                    "part": pa.array([p] * len(sums), pa.int32()),
                    "entry": pa.array([entry] * len(sums), pa.int32()),
                    "position": pa.array(range(len(sums)), pa.int32()),
                    "total": pa.array([str(s) for s in sums], pa.string()),
                    "parts": pa.array([count] * len(sums), pa.int64()),
                }
            )

    per_task = rows.select("embedding", "code").mapInArrow(
        add, "length int, part int, entry int, position int, total string, parts bigint"
    )
    return per_task.groupBy("length", "part", "entry", "position").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("parts").alias("parts")
    )


def _moved(books: Codebooks, sums: DataFrame) -> Codebooks:
    """Entries replaced by their parts' floored means; the driver sees one row a component."""
    moved = {length: [entries.copy() for entries in parts] for length, parts in books.items()}
    for row in sums.collect():
        mean = int(row["total"]) // row["parts"]
        moved[row["length"]][row["part"]][row["entry"], row["position"]] = mean
    return moved


def _first_entries(rows: DataFrame) -> Codebooks:
    """The parts of the vectors with the smallest ids, for each length of vectors."""
    first = Window.partitionBy(F.size("embedding")).orderBy(F.col("vec_id").asc_nulls_last(), "embedding")
    # Spark keeps so many rows of each length per task before it shuffles.
    chosen = rows.withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= ENTRIES)
    vectors: dict[int, list] = {}
    for row in chosen.orderBy("nth").select("embedding").collect():
        vectors.setdefault(len(row[0]), []).append(row[0])
    books = {}
    for length, some in vectors.items():
        matrix = _integers(np.array(some, dtype=np.float64).reshape(len(some), length))
        books[length] = [matrix[:, low:high] for low, high in cuts(length)]
    return books


def codebook_digest(parts: list[np.ndarray]) -> str:
    """SHA-256 of all components by part, entry and position, in decimal, joined by commas."""
    text = ",".join(str(int(x)) for entries in parts for x in entries.ravel())
    return hashlib.sha256(text.encode()).hexdigest()


def usable_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id, label, embedding`` of the vectors without null or non-finite components."""
    unusable = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.select("vec_id", "label", "embedding").filter(F.col("embedding").isNotNull() & ~unusable)


def fit_codebooks(rows: DataFrame) -> tuple[Codebooks, DataFrame]:
    """Codebooks after all rounds, and the rows with their ``code`` of the last one.

    Each round writes the rows with their codes, and forgets those of the round before.
    """
    books = _first_entries(rows)
    coded = rows.withColumn("code", F.lit(bytes(PARTS)))
    before = None
    for _ in range(ROUNDS if books else 0):
        coded = written(_reassigned(coded, books))
        if before is not None:
            forget(before)
        before = coded
        books = _moved(books, _sums(coded))
    return books, coded


def vector_codes(vectors: DataFrame) -> DataFrame:
    """One row per usable vector: ``vec_id, code, error, label_error, codebooks_sha256``.

    Components are scaled and floored; each part position's codebook starts as that part of the
    ``ENTRIES`` vectors with the smallest ids (nulls last, equal ids by their components) and
    is moved ``ROUNDS`` times. ``code`` has two hexadecimal digits a part, ``error`` is the
    squared distance from the entries, ``label_error`` its sum over rows of the same label.

    Vectors that are null or hold null or non-finite components are dropped. Rows that
    repeat an id count each. With fewer vectors than entries there are so many entries. Vectors of
    each length have codebooks of their own, which the driver holds: ``ENTRIES`` vectors a length; a
    length that the parts do not divide is cut as evenly as it can be. Scaled components
    beyond 2**60 count as 2**60, errors beyond the largest long as that. Other columns
    are ignored; no rows give no rows.
    """
    rows = usable_vectors(vectors)
    books, coded = fit_codebooks(rows)
    digests = {length: codebook_digest(parts) for length, parts in books.items()}
    kinds = dict(rows.dtypes)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, errors = _assigned(batch, books)
            lengths = batch.column("embedding").value_lengths().to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    batch.column("label"),
                    pa.array([c.tobytes().hex() for c in codes], pa.string()),
                    pa.array([min(int(e), (1 << 63) - 1) for e in errors], pa.int64()),
                    pa.array([digests[n] for n in lengths], pa.string()),
                ],
                names=["vec_id", "label", "code", "error", "codebooks_sha256"],
            )

    done = written(
        coded.mapInArrow(
            finish,
            f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error bigint, codebooks_sha256 string",
        )
    )
    sums = written(
        done.groupBy(F.col("label").alias("of"))
        .agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("total"))
        .withColumn("label_error", F.least("total", F.lit((1 << 63) - 1).cast("decimal(38,0)")).cast("bigint"))
    )
    return done.join(sums, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", "codebooks_sha256"
    )


def oracle(length: int = 64) -> str:
    """The same codes in SQL, for vectors of one length that the parts divide."""
    width = length // PARTS
    steps = [
        f"""kept AS MATERIALIZED (
  SELECT vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cells AS MATERIALIZED (
  SELECT vec_id, (i // {width})::BIGINT AS part, (i % {width})::BIGINT AS place,
    floor({SCALE} * embedding[i + 1]::DOUBLE)::BIGINT AS x
  FROM kept, range({length}) g(i)),
book0 AS MATERIALIZED (
  SELECT part, entry, place, x AS c FROM cells
  JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept
        ORDER BY vec_id LIMIT {ENTRIES}) USING (vec_id))"""
    ]
    for r in range(ROUNDS + 1):
        steps.append(
            f"""near{r} AS MATERIALIZED (
  SELECT vec_id, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM (
    SELECT vec_id, part, entry, sum((x - c) * (x - c))::BIGINT AS d
    FROM cells JOIN book{r} USING (part, place) GROUP BY vec_id, part, entry)
  GROUP BY vec_id, part)"""
        )
        if r < ROUNDS:
            steps.append(
                f"""book{r + 1} AS MATERIALIZED (
  SELECT part, entry, place, coalesce(m, c) AS c FROM book{r} LEFT JOIN (
    SELECT part, entry, place,
      (sum(x)::HUGEINT - ((sum(x)::HUGEINT % count(*)) + count(*)) % count(*)) // count(*) AS m
    FROM cells JOIN near{r} USING (vec_id, part) GROUP BY part, entry, place)
  USING (part, entry, place))"""
            )
    return (
        "WITH "
        + ",\n".join(steps)
        + f""",
coded AS (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code,
    sum(d)::BIGINT AS error FROM near{ROUNDS} GROUP BY vec_id),
digest AS (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY part, entry, place)) AS codebooks_sha256
  FROM book{ROUNDS})
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN kept USING (vec_id), digest"""
    )
