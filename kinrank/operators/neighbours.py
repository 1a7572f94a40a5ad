"""User-neighbourhood recommendation with Pearson similarity.

Ratings are (user_id, product_id, rating), unique per (user, product).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinrank.functions.scores import VARIANCE_NOISE, block_of, covariance_parts
from kinrank.operators.blocks import (
    Nearest,
    Side,
    Tile,
    best_per_row,
    block_count,
    cell_partitions,
    tile_buffer,
    tile_sums,
    tiles_of,
)
from kinrank.operators.packed import RANKED_USERS, Scale, Sums, Whole, similar
from kinrank.operators.selection import with_fold
from kinrank.operators.splits import TEST, TRAIN, split_hash
from kinrank.operators.topn import top_n, without_rated
from kinrank.session import written

# Size of a neighbourhood, and how many neighbours must have rated a product
# before it gets an estimate.
NEIGHBOURS = 25
LEAST_RATERS = 2

# Larger blocks copy a rating less often; a cell holds the ratings of its two blocks, and sums of two tiles.
BLOCK_USERS = 65_536
BLOCK_RATINGS = 4_000_000
# Pairs whose similarity is worked out at once: few, so that they stay in the processor's cache.
RANKED_PAIRS = 32_768
# More than similarities lose that are worked out in numbers of half the size.
ROUGH = 1e-5
# Rounds in which users and products take each other's labels.
LABEL_ROUNDS = 3
# Ratings of a neighbour that are joined in one part.
SEGMENT_RATINGS = 1000
# Raters whose products a cell adds up at once.
RATERS_PER_STEP = 200_000

SUMS = ["n", "sx", "sy", "sxx", "syy", "sxy"]


def _pearson_column() -> Column:
    """Pearson similarity from the sums of ``SUMS``; null where it is undefined."""
    n, sx, sy, sxx, syy, sxy = (F.col(name) for name in SUMS)
    vx, vy, cov = covariance_parts(n, sx, sy, sxx, syy, sxy)
    defined = (vx > VARIANCE_NOISE * n * sxx) & (vy > VARIANCE_NOISE * n * syy)
    similarity = cov / (F.sqrt(vx) * F.sqrt(vy))
    return F.when(defined, F.greatest(F.least(similarity, F.lit(1.0)), F.lit(-1.0)))


def pearson_array(sums: np.ndarray) -> np.ndarray:
    """The same for arrays; NaN where it is undefined."""
    n, _, _, sxx, syy, _ = sums
    vx, vy, cov = covariance_parts(*sums)
    defined = (vx > VARIANCE_NOISE * n * sxx) & (vy > VARIANCE_NOISE * n * syy)
    scale = np.sqrt(np.where(defined, vx, 1.0)) * np.sqrt(np.where(defined, vy, 1.0))
    return np.where(defined, np.clip(cov / scale, -1.0, 1.0), np.nan)


def typed_ratings(ratings: DataFrame) -> DataFrame:
    return ratings.select(
        F.col("user_id").cast("bigint").alias("user_id"),
        F.col("product_id").cast("bigint").alias("product_id"),
        F.col("rating").cast("double").alias("rating"),
    )


def pair_similarity(ratings: DataFrame, pairs: DataFrame) -> DataFrame:
    """Similarity of given (user_id, neighbour_id) pairs: ``n`` products in common, ``sim``.

    Pairs without a defined similarity are left out. The work is the pairs times the
    ratings of one user.
    """
    mine = typed_ratings(ratings).select("user_id", "product_id", F.col("rating").alias("x"))
    theirs = typed_ratings(ratings).select(
        F.col("user_id").alias("neighbour_id"), "product_id", F.col("rating").alias("y")
    )
    x, y = F.col("x"), F.col("y")
    return (
        pairs.select("user_id", "neighbour_id")
        .join(mine, "user_id")
        .join(theirs, ["neighbour_id", "product_id"])
        .groupBy("user_id", "neighbour_id")
        .agg(
            F.count("*").alias("n"),
            F.sum(x).alias("sx"),
            F.sum(y).alias("sy"),
            F.sum(x * x).alias("sxx"),
            F.sum(y * y).alias("syy"),
            F.sum(x * y).alias("sxy"),
        )
        .withColumn("sim", _pearson_column())
        .where(F.col("sim").isNotNull())
        .select("user_id", "neighbour_id", "n", "sim")
    )


def user_neighbours(
    ratings: DataFrame,
    targets: DataFrame | None = None,
    k: int | None = NEIGHBOURS,
    target_ratings: DataFrame | None = None,
    block_users: int = BLOCK_USERS,
    blocking: str = "hash",
) -> DataFrame:
    """The ``k`` most similar users of each target: user_id, neighbour_id, n, sim, rank.

    Targets are everybody, the users in ``targets``, or people who bring their own
    ``target_ratings``. Negative similarities count, undefined ones do not, and nobody is
    their own neighbour. ``k=None`` gives every defined similarity of given targets; for
    everybody that would be all pairs, and is refused.

    Target users and users are dealt into blocks (see :func:`user_blocks` for ``blocking``); a cell
    of two blocks receives the ratings of the products both sides rated, a bounded number, and adds
    them up tile by tile: some of its users with some others at a time. So blocks are large, a
    rating is copied to few cells, and at most ``k`` rows a user leave a cell.
    """
    if k is None and targets is None and target_ratings is None:
        raise ValueError("all similarities are only given for targets")
    ratings = typed_ratings(ratings)
    mine, side = ratings, Side.of(ratings)
    mine_side = side
    if target_ratings is not None:
        mine = typed_ratings(target_ratings)
        mine_side = Side.of(mine)
    elif targets is not None:
        targets = targets.select("user_id").distinct()
        mine = ratings.join(targets, "user_id", "left_semi")
        mine_side = Side.of(ratings, targets)

    cores = ratings.sparkSession.sparkContext.defaultParallelism
    everybody = targets is None and target_ratings is None
    if everybody:
        # every two blocks meet once
        target_blocks = other_blocks = all_blocks(side, block_users, cores)
        dealt = [with_block(ratings, other_blocks, blocking)] * 2
    else:
        target_blocks = block_count(mine_side, block_users, BLOCK_RATINGS, 1)
        other_blocks = block_count(side, block_users, BLOCK_RATINGS, math.ceil(2 * cores / target_blocks))
        dealt = [with_block(mine, target_blocks, blocking), with_block(ratings, other_blocks, blocking)]
    copied = 16.0 * (mine_side.rows * other_blocks + side.rows * target_blocks)
    partitions = cell_partitions(ratings, target_blocks * other_blocks, copied)
    found = (
        product_cells(*dealt, once=everybody)
        .repartition(partitions, "tb", "ub")
        .groupBy("tb", "ub")
        .applyInArrow(
            _nearest_in_cell(k, everybody), "user_id bigint, neighbour_id bigint, n bigint, sim double"
        )
    )
    by_user = Window.partitionBy("user_id").orderBy(F.desc("sim"), "neighbour_id")
    ranked = found.withColumn("rank", F.row_number().over(by_user))
    return ranked if k is None else ranked.where(F.col("rank") <= k)


def all_blocks(side: Side, block_users: int, cores: int) -> int:
    """Blocks of everybody, so many that their cells, of which there are about half the square, occupy the cores."""
    return block_count(side, block_users, BLOCK_RATINGS, math.ceil(math.sqrt(6 * cores)))


def user_blocks(ratings: DataFrame, blocks: int, blocking: str = "hash") -> DataFrame:
    """``user_id, block``: everybody who rated something, in ``blocks`` blocks 0, 1, ...

    ``'hash'`` spreads users at random, so that every block has raters of every popular product.
    ``'products'`` puts users side by side who rated the same. A user's first label is the least hash of
    their products, which two users share the more often the more products they share; then products take
    the label most of their raters have, and users the one most of their products have, a few
    times. Users in the order of their labels are cut into blocks of equal size. Where tastes form groups, blocks then share few products: a product is copied to
    fewer cells, and cells of two blocks without a common product never come about. Neighbours do not
    depend on the blocks.
    """
    if blocking == "hash":
        users = ratings.select("user_id").distinct()
        return users.withColumn("block", block_of(F.col("user_id"), blocks))
    if blocking != "products":
        raise ValueError("blocking is 'hash' or 'products'")
    rated = written(ratings.select("user_id", "product_id"))
    users = rated.groupBy("user_id").agg(F.min(F.xxhash64("product_id")).alias("_label"))
    for _ in range(LABEL_ROUNDS):
        products = _most_common(rated.join(users, "user_id"), "product_id")
        users = written(_most_common(rated.join(products, "product_id"), "user_id"))
    cut = with_fold(users, ["_label", "user_id"], blocks, "block")
    return written(cut.select("user_id", (F.col("block") - 1).alias("block")))


def _most_common(labelled: DataFrame, key: str) -> DataFrame:
    """The ``_label`` that most rows of each key have, the least of equals."""
    counts = labelled.groupBy(key, "_label").agg(F.count("*").alias("_n"))
    best = F.max(F.struct(F.col("_n"), (-F.col("_label").cast("decimal(20,0)")).alias("_minus"), "_label"))
    return counts.groupBy(key).agg(best["_label"].alias("_label"))


def with_block(ratings: DataFrame, blocks: int, blocking: str = "hash") -> DataFrame:
    """``ratings`` with the ``block`` of their user; hashed blocks need no join."""
    if blocking == "hash":
        return ratings.withColumn("block", block_of(F.col("user_id"), blocks))
    return ratings.join(user_blocks(ratings, blocks, blocking), "user_id")


def cell_load(ratings: DataFrame, blocks: int, blocking: str = "hash") -> DataFrame:
    """What comparing everybody costs: ``n_cells`` that come about, ``n_rows`` of packed raters copied
    to them, ``n_raters`` in those rows."""
    ratings = typed_ratings(ratings)
    dealt = with_block(ratings, blocks, blocking)
    return product_cells(dealt, dealt).agg(
        F.countDistinct("tb", "ub").alias("n_cells"),
        F.count("*").alias("n_rows"),
        F.sum(F.size("users") + F.size("others")).alias("n_raters"),
    )


def product_cells(mine: DataFrame, theirs: DataFrame, extra: str | None = None, once: bool = False) -> DataFrame:
    """One row per product and cell (tb, ub), with the raters of both blocks.

    Ratings have the ``block`` of their user. ``users, x`` and ``others, y`` are the raters and their
    ratings; a column ``extra`` of the ratings comes along as ``x_extra`` and ``y_extra``. With ``once``
    only cells with tb <= ub come about, for blocks that are the same on both sides.

    Raters are packed per product and block before anything is joined. A pair is rated
    once, so a packed row holds at most one block of users, and a product that everybody
    rated is one row per block. A packed row of targets is copied to the blocks in which
    its product has raters, and joined by product and block, so that a hot product is as
    many join keys as it has blocks.
    """

    def packed(ratings: DataFrame, block: str, who: str, rated: str) -> DataFrame:
        raters = F.collect_list(F.struct("user_id", "rating", *([extra] if extra else [])))
        return (
            ratings.groupBy("product_id", F.col("block").alias(block))
            .agg(raters.alias("raters"))
            .select(
                "product_id",
                block,
                F.col("raters.user_id").alias(who),
                F.col("raters.rating").alias(rated),
                *([F.col("raters")[extra].alias(f"{rated}_extra")] if extra else []),
            )
        )

    present = theirs.groupBy("product_id").agg(F.collect_set("block").alias("blocks"))
    left = packed(mine, "tb", "users", "x").join(present, "product_id")
    left = left.withColumn("ub", F.explode("blocks")).drop("blocks")
    if once:
        left = left.where(F.col("tb") <= F.col("ub"))
    right = packed(theirs, "ub", "others", "y")
    columns = ["tb", "ub", "users", "x", "others", "y"] + (["x_extra", "y_extra"] if extra else [])
    return left.join(right, ["product_id", "ub"]).select(*columns)


def product_steps(batch: pa.RecordBatch):
    """Products of a batch, a bounded number of raters at a time."""
    raters = np.maximum.reduce(
        [batch.column(c).value_lengths().to_numpy(zero_copy_only=False) for c in ("users", "others")]
    )
    step = np.cumsum(raters) // RATERS_PER_STEP
    cuts = np.flatnonzero(np.diff(step, prepend=-1))
    for first, last in zip(cuts, [*cuts[1:], batch.num_rows], strict=True):
        yield batch.slice(first, last - first)


def flat_lists(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray]:
    """The values of a column of lists, and how many each list has."""
    lists = batch.column(column)
    return lists.flatten().to_numpy(), lists.value_lengths().to_numpy()


def cell_tiles(batches: Iterator[pa.RecordBatch], extra: bool = False) -> tuple[list[Tile], list[Tile]]:
    """Both blocks of a cell in tiles."""
    sides: list[list[list[np.ndarray]]] = [[[] for _ in range(3 + extra)] for _ in range(2)]
    n_products = 0
    for batch in batches:
        for some in product_steps(batch):
            number = np.arange(n_products, n_products + some.num_rows, dtype=np.int32)
            n_products += some.num_rows
            for side, who, rated in ((sides[0], "users", "x"), (sides[1], "others", "y")):
                ids, raters = flat_lists(some, who)
                columns = [ids.copy(), flat_lists(some, rated)[0].copy(), np.repeat(number, raters)]
                if extra:
                    columns.append(flat_lists(some, f"{rated}_extra")[0].astype(np.int32))
                for kept, column in zip(side, columns, strict=True):
                    kept.append(column)
    mine, theirs = (tiles_of(*[np.concatenate(side.pop(0)) for _ in range(3 + extra)]) for side in sides)
    return mine, theirs


def offer_similar(mine: Nearest, theirs: Nearest | None, sums: Sums) -> None:
    """Give some users and others each other as neighbours; without ``theirs`` only the first ones.

    Rough similarities tell most pairs apart from the best so far; what is left is worked out exactly.
    """
    similarity = sums.similarity
    hits = _hits(mine, theirs, similarity)
    sides = [(mine, 1)] if theirs is None else [(mine, 1), (theirs, 0)]
    if np.count_nonzero(hits) > 2 * sum(math.inf if best.k is None else best.k * len(best.users) for best, _ in sides):
        for best, axis in sides:
            if best.k < similarity.shape[axis]:
                # the k-th here is no better than the k-th of all
                defined = np.where(np.isnan(similarity), -np.inf, similarity)
                last = similarity.shape[axis] - best.k
                best.raise_least(np.partition(defined, last, axis=axis).take(last, axis=axis) - ROUGH)
        hits = _hits(mine, theirs, similarity)
    pairs = np.flatnonzero(hits)
    if not len(pairs):
        return
    row, column = np.divmod(pairs, similarity.shape[1])
    chosen = sums.at(pairs)
    exact = pearson_array(chosen)
    mine.add(row, sums.others[column], exact, chosen[0])
    mine.settle(mine.crowd)
    if theirs is not None:
        theirs.add(column, sums.users[row], exact, chosen[0])
        theirs.settle(theirs.crowd)


def _hits(mine: Nearest, theirs: Nearest | None, similarity: np.ndarray) -> np.ndarray:
    """Pairs that may be among the best of one of them."""
    hits = similarity >= (mine.least - ROUGH).astype(similarity.dtype)[:, None]
    if theirs is not None:
        hits |= similarity >= (theirs.least - ROUGH).astype(similarity.dtype)
    return hits


def offer(mine: Nearest, theirs: Nearest | None, sums: np.ndarray, others: np.ndarray) -> None:
    """Give the users of two tiles each other as neighbours; without ``theirs`` only the first ones.

    Similarities are first worked out in the type of the sums, which tells most pairs apart from the
    best so far; what is left is worked out exactly.
    """
    step = max(1, RANKED_PAIRS // len(others))
    few = [math.inf if best is None or best.k is None else 8 * best.k for best in (mine, theirs)]
    columns = []
    if theirs is not None:
        least = (theirs.least - ROUGH).astype(sums.dtype)
    for first in range(0, len(mine.users), step):
        part = sums[:, first : first + step]
        vx, vy, similarity = covariance_parts(*part)
        np.maximum(vx, 0, out=vx)
        np.maximum(vy, 0, out=vy)
        scale = np.sqrt(vx, out=vx)
        scale *= np.sqrt(vy, out=vy)
        with np.errstate(divide="ignore", invalid="ignore"):
            similarity /= scale
        similarity[mine.users[first : first + step, None] == others] = np.nan
        hits = similarity >= (mine.least[first : first + step, None] - ROUGH).astype(sums.dtype)
        row, column = np.divmod(np.flatnonzero(hits), len(others))
        if len(row) > few[0] * len(part[0]):
            _offer_best(mine, first, part, others)
        else:
            _offer_exactly(mine, row, column, first, part, others)
        if theirs is not None and columns is not None:
            row, column = np.divmod(np.flatnonzero(similarity >= least), len(others))
            columns.append((row + first, column))
            if sum(len(row) for row, _ in columns) > few[1] * len(others):
                columns = None
    mine.settle(mine.crowd)
    if theirs is None:
        return
    turned = sums.transpose(0, 2, 1)
    if columns is None:
        step = max(1, RANKED_PAIRS // len(mine.users))
        for first in range(0, len(others), step):
            _offer_best(theirs, first, turned[:, first : first + step], mine.users)
    else:
        row, column = (np.concatenate(c) for c in zip(*columns, strict=True))
        _offer_exactly(theirs, column, row, 0, turned, mine.users)
    theirs.settle(theirs.crowd)


def _offer_exactly(best: Nearest, row, column, first: int, part: np.ndarray, others: np.ndarray) -> None:
    chosen = part[:, row, column].astype(np.float64)
    best.add(row + first, others[column], pearson_array(chosen), chosen[0])


def _offer_best(best: Nearest, first: int, part: np.ndarray, others: np.ndarray) -> None:
    similarity = pearson_array(part.astype(np.float64))
    users = best.users[first : first + len(similarity), None]
    similarity[(users == others) | (similarity < best.least[first : first + len(similarity), None])] = np.nan
    # others are in ascending order, so ties go to the lower neighbour
    row, column = best_per_row(similarity, len(others) if best.k is None else best.k)
    best.add(row + first, others[column], similarity[row, column], part[0][row, column])


def meet(mine: list[Tile], theirs: list[Tile], k: int | None, both: bool, same: bool, buffer: np.ndarray):
    """The best of some users of a cell at a time: all tiles of one block meet those of the other.

    With ``both`` the other block's users look for neighbours, too; ``same`` says that the blocks are
    one, where every two tiles meet once. Whole numbers meet in packed sums, where they fit.
    """
    bests = [_parts(tile, k) for tile in mine]
    other_bests = bests if same else [_parts(tile, k) for tile in theirs] if both else None
    whole = [Whole.of(tile) for tile in mine]
    other_whole = whole if same else [Whole.of(tile) for tile in theirs]
    for i, one in enumerate(mine):
        for j, other in enumerate(theirs):
            if same and j < i:
                continue
            scale = whole[i] and other_whole[j] and Scale.of(whole[i], other_whole[j])
            alike = same and i == j
            if scale:
                for a, b, sums in similar(whole[i], other_whole[j], scale, buffer, alike):
                    partner = other_bests[j][b] if both and not (alike and a == b) else None
                    offer_similar(bests[i][a], partner, sums)
                continue
            sums = tile_sums(one, other, buffer)
            if sums is None:
                continue
            for a, best in enumerate(bests[i]):
                rows = slice(a * RANKED_USERS, a * RANKED_USERS + len(best.users))
                for b, start in enumerate(range(0, len(other.ids), RANKED_USERS)):
                    if alike and b < a:
                        continue
                    partner = other_bests[j][b] if both and not (alike and a == b) else None
                    columns = slice(start, start + RANKED_USERS)
                    offer(best, partner, sums[:, rows, columns], other.ids[columns])
    found = bests if same or not both else bests + other_bests
    return [best for parts in found for best in parts]


def _parts(tile: Tile, k: int | None) -> list[Nearest]:
    """Nobody's neighbours yet, for ``RANKED_USERS`` of a tile at a time."""
    return [Nearest(tile.ids[first : first + RANKED_USERS], k) for first in range(0, len(tile.ids), RANKED_USERS)]


def same_block(mine: list[Tile], theirs: list[Tile]) -> bool:
    """Whether the two blocks of a cell, where every two blocks meet once, are one."""
    return len(mine) == len(theirs) and all(np.array_equal(a.ids, b.ids) for a, b in zip(mine, theirs, strict=True))


def _nearest_in_cell(k: int | None, both: bool):
    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine, theirs = cell_tiles(batches)
        same = both and same_block(mine, theirs)
        for best in meet(mine, theirs, k, both, same, tile_buffer(mine, theirs)):
            yield pa.RecordBatch.from_pydict(best.found())

    return nearest


def knn_estimate(
    neighbours: DataFrame, ratings: DataFrame, pairs: DataFrame | None = None
) -> DataFrame:
    """Estimated ratings: user_id, product_id, ``n`` neighbours who rated it, ``score``.

    For every product a neighbour rated, or only for the given (user, product) ``pairs``.
    Needs at least two such neighbours. The estimate is the mean of their ratings weighted
    by similarity, kept within the observed ratings.
    """
    ratings = typed_ratings(ratings)
    theirs = ratings.select(
        F.col("user_id").alias("neighbour_id"), "product_id", F.col("rating").alias("_rating")
    )
    near = neighbours.select("user_id", "neighbour_id", "sim")
    observed = ratings.agg(
        F.struct(F.min("rating").alias("low"), F.max("rating").alias("high")).alias("observed")
    ).scalar()
    mean = F.col("_num") / F.col("_den")
    if pairs is None:
        rated = _spread(near, theirs)
    else:
        rated = (
            pairs.select("user_id", "product_id")
            .join(near, "user_id")
            .join(theirs, ["neighbour_id", "product_id"])
        )
    return (
        rated.groupBy("user_id", "product_id")
        .agg(
            F.count("*").alias("n"),
            F.sum(F.col("sim") * F.col("_rating")).alias("_num"),
            F.sum("sim").alias("_den"),
        )
        # similarities that cancel out leave rounding noise instead of zero
        .where((F.col("n") >= LEAST_RATERS) & (F.round("_den", 9) != 0))
        .withColumn("score", F.round(F.greatest(F.least(mean, observed.high), observed.low), 6))
        .select("user_id", "product_id", "n", "score")
    )


def _spread(near: DataFrame, theirs: DataFrame) -> DataFrame:
    """Every neighbour's ratings for each user they are near to.

    A neighbour's products are cut into segments of about ``SEGMENT_RATINGS``, and the
    users near to them are copied to the segments they have: a neighbour who rated a lot
    and is near to many is that many join keys instead of one. A segment stays packed until it
    is where its user is, so that a user's products are added up without moving them once more.
    """
    largest = theirs.groupBy("neighbour_id").count().agg(F.max("count")).first()[0] or 1
    segments = math.ceil(largest / SEGMENT_RATINGS)
    rated = F.collect_list(F.struct("product_id", "_rating"))
    packed = (
        theirs.groupBy("neighbour_id", block_of(F.col("product_id"), segments).alias("_segment"))
        .agg(rated.alias("_rated"))
        .select(
            "neighbour_id", "_segment", F.col("_rated.product_id").alias("_products"), F.col("_rated._rating").alias("_ratings")
        )
    )
    present = theirs.select("neighbour_id", block_of(F.col("product_id"), segments).alias("_segment")).distinct()
    if segments == 1:
        copied = near.withColumn("_segment", F.lit(0))
    else:
        copied = near.join(present, "neighbour_id")
    gathered = (
        copied.join(packed, ["neighbour_id", "_segment"]).select("user_id", "sim", "_products", "_ratings").repartition("user_id")
    )
    each = F.explode(F.arrays_zip("_products", "_ratings")).alias("_each")
    return gathered.select("user_id", "sim", each).select(
        "user_id", F.col("_each._products").alias("product_id"), "sim", F.col("_each._ratings").alias("_rating")
    )


def knn_recommend(
    ratings: DataFrame,
    targets: DataFrame | None = None,
    n: int = 10,
    k: int = NEIGHBOURS,
    target_ratings: DataFrame | None = None,
) -> DataFrame:
    """The ``n`` best estimated products each target has not rated."""
    neighbours = user_neighbours(ratings, targets, k, target_ratings)
    own = ratings if target_ratings is None else target_ratings
    return top_n(without_rated(knn_estimate(neighbours, ratings), own), n)


def knn_mae(ratings: DataFrame, train_tenths: int = 9, k: int = NEIGHBOURS) -> DataFrame:
    """Mean absolute error on held-out pairs: n_test, n_scored, n_missing, mae.

    Pairs without an estimate are counted but not averaged. Neighbours are found for all
    training users, as nearly all of them have a held-out pair.
    """
    split = split_hash(typed_ratings(ratings), train_tenths)
    train = split.where(F.col("split") == TRAIN).drop("split")
    test = split.where(F.col("split") == TEST).drop("split")
    estimates = knn_estimate(user_neighbours(train, k=k), train, test)
    error = F.abs(F.col("score") - F.col("rating"))
    scored = F.count("score")
    return test.join(estimates, ["user_id", "product_id"], "left").agg(
        F.count("*").alias("n_test"),
        scored.alias("n_scored"),
        (F.count("*") - scored).alias("n_missing"),
        F.avg(error).alias("mae"),
    )
