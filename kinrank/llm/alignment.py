"""Where the tokens of two tokenizers meet in the same text.

A byte-level BPE (A, tokenizers library) encodes a space and the text, a sentencepiece model
(B) the text, whose first piece brings that space. Both libraries tell where their tokens
end: A in characters, B in bytes. Where a text is ASCII these cuts are exact; elsewhere
several tokens may share a character (parts of a multibyte character, byte-fallback pieces),
and the bytes that the tokens decode to say where in it each one ends.

Neither tokenizer merges across a space that follows a visible character, so texts are cut
there, and what lies between is aligned once and remembered; a model that could merge across
is given whole texts. Two tokens are linked where they end together. The one's bytes are
then the end of the other's, so the vocabularies alone bound the number of linked id pairs
(:func:`pair_bound`), whatever the corpus: only their counts are broadcast.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinrank.llm.tables import texts
from kinrank.llm.worker import remembered, slices, without_collection
from kinrank.session import written

# Stretches of text that a worker remembers twice over, if they are no longer than so many characters.
REMEMBERED, LONG = 180_000, 64
# Characters worked on, and characters given to the tokenizers, at once.
AT_ONCE, LEARNED = 1 << 20, 1 << 15
# Links looked up at once.
LOOKED_UP = 1 << 19
# A space behind a visible character of ASCII or a letter of the Latin blocks.
_CUT = re.compile("(?<=[!-~À-ÖØ-öø-ɏ]) ")
_VISIBLE = re.compile("[!-~À-ÖØ-öø-ɏ]").match
SPACE = "▁"

# What one stretch of text gives: tokens of A, of B, groups as text, links as packed id pairs.
Aligned = tuple[int, int, str, bytes]


def _byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: printable Latin-1 ones are
    themselves, all others in order from 256."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(other)}


class ByteLevel:
    """Tokenizer A, from the text of a tokenizers definition."""

    def __init__(self, definition: str):
        # One thread: the cores belong to other tasks.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.encode_special_tokens = True
        letters = _byte_letters()
        added = {t["content"] for t in json.loads(definition).get("added_tokens") or []}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes: list[bytes] = [b""] * (max(vocabulary.values()) + 1)
        for entry, k in vocabulary.items():
            plain = entry in added or any(c not in letters for c in entry)
            self.bytes[k] = entry.encode() if plain else bytes(letters[c] for c in entry)

    def encode(self, text: str) -> tuple[list[int], list[int]]:
        """Ids, and the character behind each token."""
        (found,) = self.tokenizer.encode_batch([text], add_special_tokens=False)
        return found.ids, [end for _, end in found.offsets]


class Pieces:
    """Tokenizer B, from the bytes of a sentencepiece model."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [self.model.id_to_piece(k) for k in range(self.model.get_piece_size())]
        self.bytes = [
            bytes([int(name[3:5], 16)]) if self.model.is_byte(k) else name.replace(SPACE, " ").encode()
            for k, name in enumerate(names)
        ]
        ids = {name: k for k, name in enumerate(names)}
        self.space = ids.get(SPACE)
        # Does nothing that lies before a space change what follows it?
        probe = [ids.get(SPACE), *self.model.encode("a")] if self.space is not None else None
        self.splits = (
            probe is not None
            and not any(re.search(f"[^{SPACE}]{SPACE}", name) for name in names)
            and self.model.encode("a a ") == [*self.model.encode("a"), *self.model.encode("a"), self.space]
            and self.model.encode(" a") == probe
        )

    def encode(self, text: str) -> tuple[list[int], list[int]]:
        """For a text with a leading space, ids and the byte behind each token."""
        if text == " " and self.space is not None:
            return [self.space], [1]
        pieces = self.model.encode(text[1:], return_type="proto").pieces
        return [p.id for p in pieces], [p.end + 1 for p in pieces]


class Aligner:
    """Aligns texts, remembering the stretches they are made of."""

    def __init__(self, definition: str, model: bytes):
        self.a, self.b = ByteLevel(definition), Pieces(model)
        self.names = [str(k) for k in range(max(len(self.a.bytes), len(self.b.bytes)))]
        # Those met of late, and those met in the stretch of texts before.
        self.known: dict[str, Aligned | None] = {}
        self.before: dict[str, Aligned | None] = {}

    def _tokens(self, text: str) -> list[tuple[list[int], np.ndarray]] | None:
        """Ids of A and of B with the byte behind each token, or None where they are not the text."""
        data, found = text.encode(), []
        for side in (self.a, self.b):
            ids, ends = side.encode(text)
            parts = [side.bytes[k] for k in ids]
            if b"".join(parts) != data:
                return None
            if len(data) != len(text):
                # Tokens may end inside a character: their bytes say where.
                ends = np.cumsum([len(p) for p in parts])
            found.append((ids, np.array(ends, dtype=np.int64)))
        return found

    def _together(self, some: list[str]) -> list[Aligned | None]:
        """Stretches that stand behind each other as in a text."""
        found = self._tokens("".join([" " + s for s in some]))
        if found is None:
            if len(some) == 1:
                return [None]
            half = len(some) // 2
            return self._together(some[:half]) + self._together(some[half:])
        (ids_a, ends_a), (ids_b, ends_b) = found
        # A token of A and one of B end at each of these.
        cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
        last_a, last_b = np.searchsorted(ends_a, cuts), np.searchsorted(ends_b, cuts)
        width = len(self.b.bytes)
        links = (np.array(ids_a, dtype=np.int64)[last_a] * width + np.array(ids_b, dtype=np.int64)[last_b]).astype("<i8")
        groups, names, i, j = [], self.names, 0, 0
        for a, b in zip((last_a + 1).tolist(), (last_b + 1).tolist(), strict=True):
            if a - i == 1 and b - j == 1:
                groups.append(f"{ids_a[i]}|{ids_b[j]}")
            else:
                groups.append(f"{','.join([names[k] for k in ids_a[i:a]])}|{','.join([names[k] for k in ids_b[j:b]])}")
            i, j = a, b
        stretch_ends = np.cumsum([1 + (len(s) if s.isascii() else len(s.encode())) for s in some])
        behind = [np.searchsorted(ends, stretch_ends, side="right").tolist() for ends in (ends_a, ends_b, cuts)]
        aligned, packed, low = [], links.tobytes(), (0, 0, 0)
        for high in zip(*behind, strict=True):
            aligned.append(
                (high[0] - low[0], high[1] - low[1], ";".join(groups[low[2] : high[2]]), packed[8 * low[2] : 8 * high[2]])
            )
            low = high
        return aligned

    def _learn(self, stretches: Iterable[str]) -> dict[str, Aligned | None]:
        found, together, size = {}, [], 0
        for stretch in stretches:
            if self.b.splits and _VISIBLE(stretch[-1:]):
                together.append(stretch)
                size += len(stretch)
                if size >= LEARNED:
                    found.update(zip(together, self._together(together), strict=True))
                    together, size = [], 0
            else:
                # What follows would not stand apart from it.
                found[stretch] = self._together([stretch])[0]
        if together:
            found.update(zip(together, self._together(together), strict=True))
        return found

    def align(self, batch: list[str]) -> list[Aligned | None]:
        """For each text its tokens, groups and links; None where a text has no tokens."""
        if len(self.known) > REMEMBERED:
            # What is met again is kept, the rest is forgotten the next time.
            self.before, self.known = self.known, {}
        known, cut = self.known, _CUT.split if self.b.splits else lambda text: [text]
        # Each stretch begins with the space that the cut took away.
        parts = [cut(text) if text else [] for text in batch]
        new = set().union(*parts) - known.keys()
        again = new & self.before.keys()
        known.update((s, self.before[s]) for s in again)
        found = self._learn(new - again)
        long = {s: aligned for s, aligned in found.items() if len(s) > LONG}
        known.update((s, aligned) for s, aligned in found.items() if len(s) <= LONG)
        if not long:
            return [self._joined([known[s] for s in some]) for some in parts]
        return [self._joined([long[s] if s in long else known[s] for s in some]) for some in parts]

    @staticmethod
    def _joined(parts: list[Aligned | None]) -> Aligned | None:
        if not parts or None in parts:
            return None
        if len(parts) == 1:
            return parts[0]
        counts_a, counts_b, groups, links = zip(*parts, strict=True)
        return sum(counts_a), sum(counts_b), ";".join(groups), b"".join(links)


def pair_bound(a: list[bytes], b: list[bytes]) -> int:
    """How many id pairs can end together at all: the one's bytes end with the other's."""

    def ends_of(tokens: list[bytes], others: list[bytes], whole: bool) -> int:
        times: dict[bytes, int] = {}
        for other in others:
            times[other] = times.get(other, 0) + 1
        return sum(
            times.get(token[k:], 0) for token in tokens for k in range(0 if whole else 1, len(token))
        )

    return ends_of(a, b, True) + ends_of(b, a, False)


def _shared(spark: SparkSession, definition: str, model: str):
    with open(definition, encoding="utf-8") as one, open(model, "rb") as other:
        return spark.sparkContext.broadcast((one.read(), other.read()))


def _link_type(definition: str, model: str) -> tuple[pa.DataType, str]:
    """The smallest type that holds every pair of ids."""
    with open(definition, encoding="utf-8") as one, open(model, "rb") as other:
        pairs = len(ByteLevel(one.read()).bytes) * len(Pieces(other.read()).bytes)
    return (pa.int32(), "int") if pairs < 1 << 31 else (pa.int64(), "bigint")


def aligned_texts(docs: DataFrame, definition: str, model: str, keep_groups: bool = False) -> DataFrame:
    """Per document ``doc_id, n_a, n_b, n_groups, groups_sha256, links`` (and ``groups``).

    ``definition`` and ``model`` are paths of a tokenizers definition (A) and a sentencepiece
    model (B). ``groups`` is ``a1,a2|b1;a3|b2,b3``; ``links`` holds one number
    ``a * size of B's vocabulary + b`` for each pair of tokens that end together.
    """
    files = _shared(docs.sparkSession, definition, model)
    kinds = _link_type(definition, model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, other = files.value
        key = ("alignment", hashlib.sha256(one.encode() + other).digest())
        aligner = remembered(key, lambda: Aligner(one, other))
        for batch in batches:
            at = 0
            for some in slices((v.as_py() for v in batch.column("text")), AT_ONCE):
                with without_collection():
                    found = aligner.align(some)
                links = [np.frombuffer(f[3], dtype="<i8") if f else np.zeros(0, "<i8") for f in found]
                offsets = np.cumsum([0, *map(len, links)])
                columns = {
                    "doc_id": batch.column("doc_id").slice(at, len(some)),
                    "n_a": pa.array([f[0] if f else 0 for f in found], pa.int64()),
                    "n_b": pa.array([f[1] if f else 0 for f in found], pa.int64()),
                    "n_groups": pa.array(np.diff(offsets), pa.int64()),
                    "groups_sha256": pa.array([hashlib.sha256(f[2].encode()).hexdigest() if f else "" for f in found]),
                    "links": pa.ListArray.from_arrays(
                        pa.array(offsets, pa.int32()), pa.array(np.concatenate(links)).cast(kinds[0])
                    ),
                }
                if keep_groups:
                    columns["groups"] = pa.array([f[2] if f else "" for f in found], pa.string())
                at += len(some)
                yield pa.RecordBatch.from_pydict(columns)

    frame = texts(docs)
    kind = dict(frame.dtypes)["doc_id"]
    schema = f"doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, links array<{kinds[1]}>"
    return frame.mapInArrow(rows, schema + ", groups string" * keep_groups)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, links``: how often each id pair is linked; added up inside tasks first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, times = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        for batch in batches:
            flat = batch.column("links").flatten().to_numpy().astype(np.int64, copy=False)
            for start in range(0, len(flat), AT_ONCE):
                new, n = np.unique(flat[start : start + AT_ONCE], return_counts=True)
                merged, place = np.unique(np.concatenate([pairs, new]), return_inverse=True)
                sums = np.zeros(len(merged), dtype=np.int64)
                np.add.at(sums, place, np.concatenate([times, n]))
                pairs, times = merged, sums
        for start in range(0, len(pairs), 10_000):
            part = slice(start, start + 10_000)
            yield pa.RecordBatch.from_pydict({"pair": pa.array(pairs[part]), "links": pa.array(times[part])})

    per_task = aligned.select("links").mapInArrow(count, "pair bigint, links bigint")
    return per_task.groupBy("pair").agg(F.sum("links").alias("links"))


def alignment(docs: DataFrame, definition: str, model: str) -> DataFrame:
    """Per document ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    Positions where tokens of A and of B both end cut them into groups; the tokens that end
    there together are linked. ``count_sum`` adds over a document's links how often the whole
    corpus links that id pair; ``n_best`` counts the links whose pair is, ties included, the
    most frequent of its B id.

    A text that is null or empty, or whose tokens of A or of B do not decode to a space and
    the text (as where the text has U+2581), has no tokens: zeros and an empty digest. Special
    tokens' strings are plain text. Rows that repeat an id or a text count each; null ids
    stay. Texts are taken whole. Other columns are ignored; no rows give no rows.
    """
    aligned = written(aligned_texts(docs, definition, model))
    with open(model, "rb") as file:
        width = len(Pieces(file.read()).bytes)
    # At most pair_bound() rows, whatever the corpus.
    counted = pair_counts(aligned).orderBy("pair").toArrow()
    pairs, counts = (counted.column(c).to_numpy() for c in ("pair", "links"))
    most = np.zeros(width, dtype=np.int64)
    np.maximum.at(most, pairs % width, counts)
    table = aligned.sparkSession.sparkContext.broadcast((pairs, counts, counts == most[pairs % width]))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, best = table.value
        for batch in batches:
            column = batch.column("links")
            lengths = column.value_lengths().to_numpy()
            # Some rows at a time, so that the looked-up numbers stay few.
            rows = np.flatnonzero(np.diff(np.cumsum(lengths) // LOOKED_UP, prepend=-1))
            for low, high in zip(rows, [*rows[1:], batch.num_rows], strict=True):
                place = np.searchsorted(pairs, column.slice(low, high - low).flatten().to_numpy())
                edges = np.concatenate([[0], np.cumsum(lengths[low:high])])
                # Running sums part at the documents; empty ones have none.
                sums, bests = (np.concatenate([[0], np.cumsum(v[place], dtype=np.int64)]) for v in (counts, best))
                part = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups")),
                        pa.array(np.diff(edges)),
                        pa.array(np.diff(bests[edges])),
                        pa.array(np.diff(sums[edges])),
                        part.column("groups_sha256"),
                    ],
                    names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
                )

    kind = dict(aligned.dtypes)["doc_id"]
    return aligned.mapInArrow(
        look_up,
        f"doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
        "count_sum bigint, groups_sha256 string",
    )
