"""Near-copies of texts by MinHash signatures and a multi-index Hamming join.

A text's signature has ``CHUNKS * LENGTH`` symbols of 16 bits, each from one minimum over the
hashes of its distinct shingles. Two signatures that differ in at most
``CHUNKS * (ERRORS + 1) - 1`` symbols have, by pigeonhole, a chunk with at most ``ERRORS``
differing symbols, and so share a key made of that chunk without some ``ERRORS`` symbols:
all choices of left-out symbols are enumerated. Texts that share a key are candidates,
however many symbols differ; links are confirmed on the full sets. At a similarity of exactly
0.8 a pair shares no key with probability 1.6e-6 for the default 10 chunks of 5 symbols.

Texts with the same set count as one node until the end. In a group of texts with one key,
first all are compared with one pivot, linked ones join their labels, and only texts whose
labels still differ meet the next pivot. What no pivot decides in a small group is listed as
pairs. The texts of large ones meet by their rarest shingles: linked texts have one in common
among the rarest fifth of either, early enough that what follows can still make up 0.8, so texts
that merely share a frame never meet, however many they are. All of it loses no link.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinrank.llm.components import components
from kinrank.llm.tables import texts
from kinrank.session import forget, written

CHUNKS, LENGTH, ERRORS = 10, 5, 1
PERCENT = 80
# Pivots tried before the rest of a group is compared otherwise.
PIVOTS = 4
# Words of 64 bits that tell which shingles a text has not.
BIT_WORDS = 32
# Up to this many texts a group's pairs are listed; beyond, rare shingles choose them.
LISTED = 32
# Bytes of text whose words are hashed at once.
AT_ONCE = 1 << 20

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_random = np.random.default_rng(20_240_229)
_BYTE = _random.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_FACTORS = _random.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(h: np.ndarray) -> np.ndarray:
    """A bijective mix of 64 bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Shingler:
    """Hashed word shingles of whole texts; words are lower-cased in A-Z only."""

    def __init__(self, width: int):
        self.width = width
        inverse = pow(_BASE, -1, 2**64)
        size = 1 << 16
        self.powers, self.inverses = (self._powers(b, size) for b in (_BASE, inverse))

    @staticmethod
    def _powers(base: int, size: int) -> np.ndarray:
        return np.concatenate(
            [[np.uint64(1)], np.cumprod(np.full(size - 1, base, dtype=np.uint64), dtype=np.uint64)]
        )

    def words(self, data: bytes) -> np.ndarray:
        """A 64-bit hash of each word, in order."""
        parts, start = [], 0
        while start < len(data):
            # Pieces end at white space, so that positions stay below the table's size.
            end = min(start + len(self.powers), len(data))
            if end < len(data):
                cut = np.flatnonzero(_SPACE[np.frombuffer(data[start:end], dtype=np.uint8)])
                if len(cut):
                    end = start + int(cut[-1]) + 1
                else:
                    end = self._end_of_word(data, end)
                    word = data[start:end].strip(b" \t\n\v\f\r")
                    parts.append(np.frombuffer(hashlib.blake2b(word, digest_size=8).digest(), dtype=np.uint64))
                    start = end
                    continue
            parts.append(self._short_words(data[start:end]))
            start = end
        return np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)

    @staticmethod
    def _end_of_word(data: bytes, start: int) -> int:
        while start < len(data):
            cut = np.flatnonzero(_SPACE[np.frombuffer(data[start : start + AT_ONCE], dtype=np.uint8)])
            if len(cut):
                return start + int(cut[0])
            start += AT_ONCE
        return len(data)

    def _short_words(self, data: bytes) -> np.ndarray:
        raw = np.frombuffer(data, dtype=np.uint8)
        space = _SPACE[raw]
        edges = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
        starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[raw] * self.powers[: len(raw)], dtype=np.uint64)])
        return _mixed((sums[ends] - sums[starts]) * self.inverses[starts] + (ends - starts).astype(np.uint64))

    def shingles(self, data: bytes) -> np.ndarray:
        """The sorted distinct shingle hashes of a text."""
        words = self.words(data.translate(_LOWER))
        if not len(words):
            return words
        width = min(self.width, len(words))
        n = len(words) - width + 1
        total = np.full(n, width, dtype=np.uint64)
        for i in range(width):
            # Beyond the table of factors a (very wide) shingle reuses them.
            total = _mixed(total + words[i : i + n] * _FACTORS[i % len(_FACTORS)])
        total.sort()
        return total[np.concatenate([[True], total[1:] != total[:-1]])]


class Signer:
    """Signatures of shingle sets, and the keys of their chunks."""

    def __init__(self, chunks: int = CHUNKS, length: int = LENGTH, errors: int = ERRORS):
        self.chunks, self.length = chunks, length
        random = np.random.default_rng(chunks * 1000 + length)
        self.hashes = random.integers(1, 2**63, chunks * length, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.weights = random.integers(1, 2**63, (chunks, length), dtype=np.uint64)
        self.left_out = list(combinations(range(length), errors))
        self.salts = random.integers(1, 2**63, (chunks, len(self.left_out)), dtype=np.uint64)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        least = None
        for i in range(0, len(shingles), 2048):
            some = (shingles[i : i + 2048, None] * self.hashes).min(axis=0)
            least = some if least is None else np.minimum(least, some)
        return (_mixed(least) >> np.uint64(48)).reshape(self.chunks, self.length)

    def keys(self, signature: np.ndarray) -> np.ndarray:
        parts = _mixed((signature + np.uint64(1)) * self.weights)
        total = parts.sum(axis=1, dtype=np.uint64)
        keys = [
            total - parts[:, list(out)].sum(axis=1, dtype=np.uint64) + self.salts[:, k]
            for k, out in enumerate(self.left_out)
        ]
        return _mixed(np.stack(keys)).ravel()


def _big_array(values: list[np.ndarray]) -> pa.Array:
    lengths = np.array([len(v) for v in values], dtype=np.int64)
    flat = np.concatenate(values) if values else np.zeros(0, dtype=np.uint64)
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat.astype(np.uint64).view(np.int64)))


def _sketches(docs: DataFrame, width: int, signer: Signer) -> DataFrame:
    """``doc_id, n_shingles, set_id, signature``; an empty set has neither id nor signature."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in batches:
            counts, sets, signatures = [], [], []
            for value in batch.column("text").cast(pa.large_binary()):
                shingles = shingler.shingles(value.as_buffer().to_pybytes())
                counts.append(len(shingles))
                if len(shingles):
                    sets.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
                    signatures.append(signer.signature(shingles).astype("<u2").tobytes())
                else:
                    sets.append(None)
                    signatures.append(None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(counts, pa.int64()),
                    pa.array(sets, pa.binary()),
                    pa.array(signatures, pa.binary()),
                ],
                names=["doc_id", "n_shingles", "set_id", "signature"],
            )

    frame = texts(docs)
    return frame.mapInArrow(
        rows, f"doc_id {dict(frame.dtypes)['doc_id']}, n_shingles bigint, set_id binary, signature binary"
    )


def _keys(classes: DataFrame, signer: Signer) -> DataFrame:
    """``key, doc, n`` for every key of every class."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                flat = np.frombuffer(b"".join(part.column("signature").to_pylist()), dtype="<u2")
                all_of = flat.reshape(-1, signer.chunks, signer.length).astype(np.uint64)
                keys = np.stack([signer.keys(signature) for signature in all_of])
                again = pa.array(np.repeat(np.arange(part.num_rows), keys.shape[1]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel().view(np.int64)), part.column("doc").take(again), part.column("n").take(again)],
                    names=["key", "doc", "n"],
                )

    kind = dict(classes.dtypes)["doc"]
    return classes.select("doc", "n", "signature").mapInArrow(rows, f"key bigint, doc {kind}, n bigint")


def _sets(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, shingles`` of the given documents."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in batches:
            column = batch.column("text").cast(pa.large_binary())
            for i in range(0, batch.num_rows, 200):
                some = [shingler.shingles(v.as_buffer().to_pybytes()) for v in column.slice(i, 200)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, len(some)), _big_array(some)], names=["doc_id", "shingles"]
                )

    frame = texts(docs)
    return frame.mapInArrow(rows, f"doc_id {dict(frame.dtypes)['doc_id']}, shingles array<bigint>")


def _sizes_allow(one: str, other: str, percent: int):
    return F.least(one, other) * 100 >= F.greatest(one, other) * percent


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets are similar enough."""
    one = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
    other = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb"))
    return (
        pairs.join(one, "a")
        .join(other, "b")
        .withColumn("common", common)
        .filter(F.col("common") * 100 >= (F.size("sa") + F.size("sb") - F.col("common")) * percent)
        .select("a", "b")
    )


def _ordered(one, other):
    return F.least(one, other).alias("a"), F.greatest(one, other).alias("b")


def _least_common(total, percent: int):
    """The fewest common shingles with which two sets of ``total`` together are similar enough."""
    return F.ceil(total * percent / (100 + percent)).cast("bigint")


def _bits(shingles: str):
    """Which of ``64 * BIT_WORDS`` bits the shingles of a text fall on."""
    places = F.transform(shingles, lambda h: h.bitwiseAND(F.lit(64 * BIT_WORDS - 1)).cast("int"))
    by_word = F.array_distinct(places)
    return F.transform(
        F.sequence(F.lit(0), F.lit(BIT_WORDS - 1)),
        lambda w: F.aggregate(
            F.filter(by_word, lambda p: F.shiftright(p, 6) == w),
            F.lit(0).cast("bigint"),
            lambda bits, p: bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), p.bitwiseAND(F.lit(63)))),
        ),
    )


def _surely_missing(one: str, other: str):
    """Shingles of the one that the other has not, as far as bits tell: never too many."""
    counts = F.zip_with(one, other, lambda a, b: F.bit_count(a.bitwiseAND(F.bitwise_not(b))))
    return F.aggregate(counts, F.lit(0), lambda total, n: total + n)


def _rare_shingles(docs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``shingle, doc, n, at, bits``: the rarest shingles of each text, in the order of how many of
    ``docs`` have them; ``at`` is a shingle's place, ``bits`` has a bit for each of the text's shingles.

    As many as it takes to have one in common with every similar text: all but the fewest that a
    similar text shares, and one more. Shingles of one text only meet nobody and are left out.
    """
    mine = written(sets.join(docs, F.col("doc_id") == F.col("doc"), "left_semi"))
    each = mine.select("doc_id", F.explode("shingles").alias("shingle"))
    # Added up inside tasks first, so a shingle that all texts have is a row a task.
    shared = written(each.groupBy("shingle").agg(F.count("*").alias("texts")).filter("texts > 1"))
    # A text's own shingles come first; only shared ones need a place among themselves.
    ranked = (
        each.join(shared, "shingle")
        .groupBy("doc_id")
        .agg(F.array_sort(F.collect_list(F.struct("texts", "shingle"))).alias("shared"))
        .join(mine.select("doc_id", F.size("shingles").cast("bigint").alias("n"), _bits("shingles").alias("bits")), "doc_id")
    )
    own = F.col("n") - F.size("shared")
    places = F.col("n") - F.ceil(F.col("n") * percent / 100).cast("bigint") + 1
    kept = F.slice("shared", F.lit(1), F.greatest(places - own, F.lit(0)).cast("int"))
    return ranked.select(
        F.col("doc_id").alias("doc"), "n", "bits", own.alias("own"), F.posexplode(kept).alias("k", "s")
    ).select(F.col("s.shingle").alias("shingle"), "doc", "n", (F.col("own") + F.col("k")).alias("at"), "bits")


def _pairs_by_rare_shingles(docs: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``a, b``: pairs of ``docs`` with different labels that may be linked; none that is linked is missing.

    The shorter one is found by the shingles that one of its own length would need, the longer
    one looks with all its rare shingles. The first common shingle must stand so early in both that
    as many can follow as the pair needs, and no more shingles of either may surely be missing from the
    other than the pair can spare: of texts near the threshold few but linked ones are left.
    """
    rare = written(_rare_shingles(docs, sets, percent).join(labels, "doc"))
    needed = _least_common(2 * F.col("n"), percent)
    found = rare.filter(F.col("at") <= F.col("n") - needed)
    one = found.select("shingle", *[F.col(c).alias(f"{c}1") for c in ("doc", "n", "at", "label", "bits")])
    # Groups of one label have nothing to find; they go before the join, and are never listed.
    several = rare.groupBy("shingle").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high")
    rare = written(rare.join(several.select("shingle"), "shingle", "left_semi"))
    shorter = (F.col("n1") < F.col("n")) | ((F.col("n1") == F.col("n")) & (F.col("doc1") < F.col("doc")))
    can_follow = F.least(F.col("n1") - F.col("at1"), F.col("n") - F.col("at"))
    can_share = F.least(F.col("n1") - _surely_missing("bits1", "bits"), F.col("n") - _surely_missing("bits", "bits1"))
    least = _least_common(F.col("n1") + F.col("n"), percent)
    return (
        rare.join(one, "shingle")
        .filter(
            (F.col("label") != F.col("label1"))
            & shorter
            & _sizes_allow("n1", "n", percent)
            & (can_follow >= least)
            & (can_share >= least)
        )
        .select(*_ordered(F.col("doc1"), F.col("doc")))
        .distinct()
    )


def _relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``doc, label`` after joining the labels of linked documents; the labels before are forgotten."""
    if links.isEmpty():
        forget(links)
        return labels
    by_a = labels.select(F.col("doc").alias("a"), F.col("label").alias("la"))
    by_b = labels.select(F.col("doc").alias("b"), F.col("label").alias("lb"))
    edges = links.join(by_a, "a").join(by_b, "b").select(F.col("la").alias("a"), F.col("lb").alias("b"))
    joined = components(edges.distinct())
    relabelled = written(
        labels.join(joined, F.col("label") == F.col("node"), "left").select(
            "doc", F.coalesce("component", "label").alias("label")
        )
    )
    forget(labels)
    forget(links)
    return relabelled


def _labels(docs: DataFrame, members: DataFrame, width: int, percent: int, listed: int):
    """The label of every text that shares a key with another; ``members``: key, doc, n."""
    ids = members.select("doc").distinct()
    sets = written(_sets(docs.join(ids, F.col("doc_id") == F.col("doc"), "left_semi"), width))
    labels = written(ids.select("doc", F.col("doc").alias("label")))
    checked = None
    for turn in range(PIVOTS + 1):
        marked = members.join(labels, "doc")
        order = F.xxhash64("doc", F.lit(turn)) if turn else F.lit(0).cast("bigint")
        pivots = (
            marked.groupBy("key")
            .agg(
                F.min(F.struct(order.alias("o"), F.col("doc").alias("pivot"), F.col("label").alias("of"), F.col("n").alias("pn"))).alias("p"),
                F.min("label").alias("low"),
                F.max("label").alias("high"),
                F.count("*").alias("size"),
            )
            .filter("low <> high")
            .select("key", "p.o", "p.pivot", "p.of", "p.pn", "size")
        )
        pivots = written(pivots)
        if turn == PIVOTS:
            break
        meetings = (
            marked.join(pivots, "key")
            .filter((F.col("label") != F.col("of")) & _sizes_allow("n", "pn", percent))
            .select("doc", "o", "pivot", *_ordered(F.col("doc"), F.col("pivot")))
        )
        if checked is not None:
            # A text mostly meets the same pivot by many keys.
            meetings = meetings.distinct().join(checked, ["a", "b"], "left_anti")
        # Each text meets one new pivot a turn, of all its keys' the first in the order.
        first = meetings.groupBy("doc").agg(F.min(F.struct("o", "pivot")).alias("p"))
        pairs = written(first.select(*_ordered(F.col("doc"), F.col("p.pivot"))).distinct())
        if pairs.isEmpty():
            break
        forget(pivots)
        checked = pairs if checked is None else checked.unionByName(pairs)
        links = written(_confirmed(pairs, sets, percent))
        labels = _relabelled(labels, links)
    # What pivots have not decided, exactly.
    rest = written(marked.join(pivots.select("key", "size"), "key").select("key", "doc", "n", "label", "size"))
    if rest.isEmpty():
        return labels
    small = rest.filter(F.col("size") <= listed)
    other = small.select("key", F.col("doc").alias("d2"), F.col("n").alias("n2"), F.col("label").alias("l2"))
    pairs = (
        small.join(other, "key")
        .filter((F.col("doc") < F.col("d2")) & (F.col("label") != F.col("l2")) & _sizes_allow("n", "n2", percent))
        .select(F.col("doc").alias("a"), F.col("d2").alias("b"))
        .distinct()
    )
    if checked is not None:
        pairs = pairs.join(checked, ["a", "b"], "left_anti")
    labels = _relabelled(labels, written(_confirmed(pairs, sets, percent)))
    large = written(rest.filter(F.col("size") > listed).select("doc").distinct())
    if large.isEmpty():
        return labels
    pairs = _pairs_by_rare_shingles(large, labels, sets, percent)
    if checked is not None:
        pairs = pairs.join(checked, ["a", "b"], "left_anti")
    return _relabelled(labels, written(_confirmed(pairs, sets, percent)))


def near_copies(
    docs: DataFrame,
    width: int = 5,
    percent: int = PERCENT,
    signer: Signer | None = None,
    listed: int = LISTED,
) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Words are runs without white space; a text's set holds its distinct shingles of
    ``width`` words, of fewer words the whole sequence. Texts are linked when
    ``100 * common >= percent * union``; ``component_id`` is the smallest id reachable by
    links, and its document is kept. Empty, blank and null texts link with nothing; so
    does a null id, which has a null component and is kept. Rows that repeat an id are one
    node with the sets of all of them. Other columns are ignored; no rows give no rows.
    """
    signer = signer or Signer()
    sketches = written(_sketches(docs, width, signer))
    usable = sketches.filter("set_id IS NOT NULL AND doc_id IS NOT NULL")
    # Equal sets have equal keys: aggregated before any shuffle, however many copies there are.
    classes = written(
        usable.groupBy("set_id").agg(
            F.min("doc_id").alias("doc"), F.min("n_shingles").alias("n"), F.first("signature").alias("signature")
        )
    )
    keys = _keys(classes, signer)
    shared = keys.groupBy("key").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).filter("low <> high")
    # Written first, so that the join reads both sides from shuffles and can split hot keys.
    members = written(keys.join(written(shared.select("key")), "key"))
    keyed = _labels(docs, members, width, percent, listed)
    # Equal sets are one class; rows that repeat an id tie their classes together.
    named = classes.join(keyed, "doc", "left").select(
        "set_id", F.coalesce("label", "doc").alias("component_id")
    )
    placed = sketches.join(named, "set_id", "left").withColumn(
        "component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    )
    placed = written(placed.drop("signature", "set_id"))
    for done in (sketches, classes, members, keyed):
        forget(done)
    placed = _repeated_ids_joined(placed)
    return placed.select(
        "doc_id",
        "n_shingles",
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def _repeated_ids_joined(placed: DataFrame) -> DataFrame:
    several = written(
        placed.filter("doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("component_id").alias("low"), F.max("component_id").alias("high"))
        .filter("low <> high")
    )
    if several.isEmpty():
        return placed
    tied = placed.join(several.select("doc_id", "low"), "doc_id").select(
        F.col("low").alias("a"), F.col("component_id").alias("b")
    )
    joined = components(tied.distinct())
    return placed.join(joined, F.col("component_id") == F.col("node"), "left").withColumn(
        "component_id", F.coalesce("component", "component_id")
    )


def without_near_copies(docs: DataFrame, width: int = 5, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs``, with all their columns, that :func:`near_copies` keeps."""
    dropped = near_copies(docs, width, percent).filter(~F.col("kept")).select("doc_id").distinct()
    return docs.join(written(dropped), "doc_id", "left_anti").select(*docs.columns)
