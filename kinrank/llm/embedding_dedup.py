"""Near-copies among embeddings by spherical k-means cells.

Centroids are fitted on a bounded sample for each length of vectors; every vector is
assigned. A vector is at home in the cell of its nearest centroid and visits all cells whose
border is so near that half a link may cross it, so that no link across a border is missed
from both sides, whatever the data look like (see ``_visits``). Visitors are compared with those at home in blocks, as matrix products in double precision; a
block's task returns for each vector how many it is linked with, and one link towards the
smallest of what it joins, never the pairs themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinrank.llm.components import components
from kinrank.session import written

THRESHOLD = 0.9
# The sample k-means is fitted on, the most cells there may be, and its rounds.
SAMPLE = 20_000
CELLS = 16_384
# Cells by the root of the vectors. The bound on visits spares few products of far cells, so many small
# cells mostly copy vectors: few large ones multiply about twice as many pairs and copy a fifth.
CELLS_BY_ROOT = 0.2
ROUNDS = 8
BLOCK = 1024
# Cosines of rows and centroids held at once.
AT_ONCE = 2_000_000
# Part of the bound on half a link that decides about visits: at 1 no link is lost.
MARGIN = 1.0


def spherical_kmeans(sample: np.ndarray, cells: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centroids of unit vectors; at most as many as there are vectors."""
    unique = np.unique(sample, axis=0)
    spread = np.random.default_rng(0).permutation(len(unique))[: min(cells, len(unique))]
    centroids = unique[spread]
    for _ in range(rounds):
        step = max(1, AT_ONCE // len(centroids))
        nearest = np.concatenate(
            [(sample[i : i + step] @ centroids.T).argmax(axis=1) for i in range(0, len(sample), step)]
        )
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, sample)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(norms > 1e-12, sums / np.maximum(norms, 1e-12), centroids)
    return centroids


def _units(column: pa.Array, width: int) -> np.ndarray:
    """Rows of unit length, padded with zeros to ``width``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    lengths = np.diff(offsets)
    result = np.zeros((len(lengths), width))
    inside = np.arange(width)[None, :] < lengths[:, None]
    result[inside] = flat[offsets[0] : offsets[0] + lengths.sum()]
    # Scaled first, so that squares neither overflow nor vanish.
    result /= np.abs(result).max(axis=1, keepdims=True)
    return result / np.linalg.norm(result, axis=1, keepdims=True)


def _usable(column: str = "embedding"):
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    vector = F.col(column)
    return (
        F.col("vec_id").isNotNull()
        & vector.isNotNull()
        & F.coalesce(F.forall(vector, finite), F.lit(False))
        & F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))
    )


def _visits(units: np.ndarray, centroids: np.ndarray, threshold: float, margin: float) -> tuple[np.ndarray, np.ndarray]:
    """The home of each unit row, and which cells it visits (its home among them).

    Let x be at home in h and y in c, linked, so that |x - y| <= sqrt(2 - 2 * threshold). By
    Cauchy-Schwarz (h - c).x + (c - h).y = (h - c).(x - y) is at most that times |h - c|.
    Neither term on the left is negative, so one of them is at most half of it: x visits c,
    or y visits h.
    """
    near = units @ centroids.T
    home = near.argmax(axis=1)
    apart = np.sqrt(np.maximum(0.0, 2 - 2 * (centroids[home] @ centroids.T)))
    half = np.sqrt(max(0.0, 2 - 2 * threshold)) / 2
    # The slack is far above what rounding does.
    visits = near.max(axis=1, keepdims=True) - near <= margin * half * apart + 1e-7
    visits[np.arange(len(home)), home] = True
    return home, visits


def _assigned(classes: DataFrame, centroids: dict[int, np.ndarray], threshold: float, margin: float) -> DataFrame:
    """``id, weight, embedding`` with the ``home`` cell and all visited ``cells``.

    Cells are numbered for each length of vectors; one without centroids has a single cell.
    """
    shared = classes.sparkSession.sparkContext.broadcast(centroids)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.diff(batch.column("embedding").offsets.to_numpy())
            for width in np.unique(lengths):
                alike = batch.take(pa.array(np.nonzero(lengths == width)[0]))
                middles = shared.value.get(int(width))
                if middles is None:
                    middles = np.eye(1, width)
                some = max(1, AT_ONCE // max(len(middles), int(width)))
                for start in range(0, alike.num_rows, some):
                    part = alike.slice(start, some)
                    home, visits = _visits(_units(part.column("embedding"), int(width)), middles, threshold, margin)
                    cells = np.nonzero(visits)[1].astype(np.int32)
                    offsets = np.concatenate([[0], np.cumsum(visits.sum(axis=1))]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(part.column(c) for c in ("id", "weight", "embedding")),
                            pa.array(home.astype(np.int32)),
                            pa.ListArray.from_arrays(pa.array(offsets), pa.array(cells)),
                        ],
                        names=["id", "weight", "embedding", "home", "cells"],
                    )

    kind = dict(classes.dtypes)
    return classes.mapInArrow(
        rows, f"id {kind['id']}, weight bigint, embedding {kind['embedding']}, home int, cells array<int>"
    )


def _linked(one: np.ndarray, other: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of unit rows reach the threshold; near it one plain sum decides."""
    cosine = one @ other.T
    linked = cosine >= threshold - 1e-12
    rows, columns = np.nonzero(linked)
    near = cosine[rows, columns] < threshold + 1e-12
    for a, b in zip(rows[near], columns[near], strict=True):
        linked[a, b] = float(np.sum(one[a] * other[b])) >= threshold
    return linked


def _compare(threshold: float):
    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        home = table.filter(pc.equal(table["visitor"], False))
        guest = table.filter(table["visitor"])
        empty = pa.table({"id": table["id"].slice(0, 0), "links": pa.array([], pa.int64()), "head": table["id"].slice(0, 0)})
        if not home.num_rows or not guest.num_rows:
            return empty
        width = home["dim"][0].as_py()
        linked = _linked(_units(guest["embedding"], width), _units(home["embedding"], width), threshold)
        if not linked.any():
            return empty
        cell = home["cell"][0].as_py()
        ids_g, ids_h = guest["id"].to_numpy(), home["id"].to_numpy()
        homes = guest["home"].to_numpy()
        # A pair at home in one cell meets twice, in either order; one across a border also
        # meets in the other cell if this side's vector visits that one.
        linked &= np.where((homes == cell)[:, None], ids_g[:, None] < ids_h[None, :], True)
        kinds, which = np.unique(homes, return_inverse=True)
        visits = np.zeros((len(ids_h), len(kinds)), dtype=bool)
        lists = home["cells"].combine_chunks()
        flat, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
        flat = flat[offsets[0] : offsets[-1]]
        owner = np.repeat(np.arange(len(ids_h)), np.diff(offsets))
        at = np.searchsorted(kinds, flat)
        hit = (at < len(kinds)) & (kinds[np.minimum(at, len(kinds) - 1)] == flat)
        visits[owner[hit], at[hit]] = True
        linked &= ~(visits[:, which].T & (homes < cell)[:, None])
        if not linked.any():
            return empty
        count_g = linked @ home["weight"].to_numpy()
        count_h = linked.T @ guest["weight"].to_numpy()
        head_g, head_h = ids_g.copy(), ids_h.copy()
        top = np.iinfo(np.int64).max
        while True:
            low_h = np.minimum(head_h, np.where(linked, head_g[:, None], top).min(axis=0))
            low_g = np.minimum(head_g, np.where(linked, low_h[None, :], top).min(axis=1))
            if (low_h == head_h).all() and (low_g == head_g).all():
                break
            head_g, head_h = low_g, low_h
        use_g, use_h = count_g > 0, count_h > 0
        return pa.table(
            {
                "id": pa.array(np.concatenate([ids_g[use_g], ids_h[use_h]])),
                "links": pa.array(np.concatenate([count_g[use_g], count_h[use_h]]).astype(np.int64)),
                "head": pa.array(np.concatenate([head_g[use_g], head_h[use_h]])),
            }
        )

    return compare


def near_vectors(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    sample: int = SAMPLE,
    cells: int | None = None,
    margin: float = MARGIN,
    block: int = BLOCK,
) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    Vectors are linked at a cosine of ``threshold`` or more, and never below it; with a
    ``margin`` of 1 or more every such link is found. Vectors of different lengths, and vectors
    that are null, zero or hold a null or non-finite component, or have no id, link with
    nothing. Identical vectors are compared once and count each other. ``component_id`` is
    the smallest id reachable by links. Rows that repeat an id are one node of the graph;
    each counts the rows that its own vector is linked with. Other columns are ignored; no
    rows give no rows.
    """
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
    rows = rows.withColumn("embedding", F.when(_usable(), F.col("embedding")))
    classes = written(
        rows.filter("embedding IS NOT NULL")
        .groupBy("embedding")
        .agg(F.min("vec_id").alias("id"), F.count("*").alias("weight"), F.max("vec_id").alias("last"))
    )
    # One row for each length of vectors.
    sizes = dict(map(tuple, classes.groupBy(F.size("embedding")).count().collect()))
    if not sizes:
        return rows.select(
            "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
        )
    chosen = classes.orderBy(F.xxhash64("id"), "id").select("embedding").limit(sample)
    # One block of numbers, not an object a component.
    alike = chosen.toArrow().column("embedding").combine_chunks()
    lengths, centroids = alike.value_lengths().to_numpy(), {}
    for width in np.unique(lengths).tolist():
        points = _units(alike.take(pa.array(np.flatnonzero(lengths == width))), width)
        wanted = max(1, round(CELLS_BY_ROOT * sizes[width] ** 0.5))
        centroids[width] = spherical_kmeans(points, cells or min(CELLS, wanted))
    placed = written(_assigned(classes, centroids, threshold, margin))
    links = written(_links(placed, threshold, block))
    heads = components(links.select(F.col("id").alias("a"), F.col("head").alias("b")))
    counts = links.groupBy("id").agg(F.sum("links").alias("links"))
    named = (
        classes.join(counts, "id", "left")
        .join(heads.withColumnRenamed("node", "id"), "id", "left")
        .select(
            "embedding",
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).cast("bigint").alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
        )
    )
    found = rows.join(named, "embedding", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    )
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _links(placed: DataFrame, threshold: float, block: int) -> DataFrame:
    """``id, links, head`` from every pair of a block of guests and one of those at home."""
    placed = placed.withColumn("dim", F.size("embedding"))
    visits = placed.withColumn("cell", F.explode("cells"))
    # At most one row for each cell and length of vectors.
    sizes = visits.groupBy("cell", "dim").agg(
        F.ceil(F.sum((F.col("cell") == F.col("home")).cast("int")) / block).cast("int").alias("homes"),
        F.ceil(F.count("*") / block).cast("int").alias("guests"),
    )
    visits = visits.join(sizes.filter("homes > 0"), ["cell", "dim"])
    columns = ["cell", "dim", "id", "weight", "home", "embedding"]
    spread = F.xxhash64("id", F.lit(3))
    guests = visits.select(
        *columns,
        # Only the visits of those at home are asked for.
        F.array().cast("array<int>").alias("cells"),
        F.lit(True).alias("visitor"),
        F.explode(F.sequence(F.lit(0), F.col("homes") - 1)).alias("i"),
        F.pmod(spread, F.col("guests")).cast("int").alias("j"),
    )
    home = visits.filter("cell = home").select(
        *columns,
        "cells",
        F.lit(False).alias("visitor"),
        F.pmod(spread, F.col("homes")).cast("int").alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("guests") - 1)).alias("j"),
    )
    both = guests.unionByName(home)
    return both.groupBy("cell", "dim", "i", "j").applyInArrow(
        _compare(threshold), "id bigint, links bigint, head bigint"
    )
