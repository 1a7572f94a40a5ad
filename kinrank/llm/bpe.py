"""Byte-level BPE in DuckDB, one connection for each Python worker.

A task cuts its texts into pieces, and only pieces that the worker has not met are encoded:
a recursive query holds them as rows (piece, position, token), joins neighbouring rows with
the merge table, and contracts in every round each piece's leftmost pair of minimum rank,
until no pair is left. Decoding joins the ids of whole texts with the vocabulary and puts
the bytes together in order. Ids are those of the tiktoken library for the same ranks:
a piece that is itself a token stays whole.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from kinrank.llm.tables import texts
from kinrank.llm.worker import Lately, remembered, slices, without_collection

# Pieces a worker remembers (see ``Lately``), and bytes of text it works on at once.
REMEMBERED = 80_000
AT_ONCE = 1 << 20
# What DuckDB may hold in one worker.
MEMORY = "160MB"
# Longer pieces are contracted at all places of the minimum rank in one round.
LONG = 64
LONG_AT_ONCE = 32 << 10
# Rounds of one recursive query over long pieces; their rows of all rounds are held.
ROUNDS = 24

_SHORT = """
WITH RECURSIVE state(word, pos, id, step) AS (
  SELECT word, pos, id, 0 FROM pieces
  UNION ALL
  SELECT s.word, if(s.pos > best.key & 4294967295, s.pos - 1, s.pos),
    if(s.pos = best.key & 4294967295, (best.key >> 32)::INTEGER, s.id), s.step + 1
  FROM state s JOIN (
    SELECT a.word, min((m.merged << 32) | a.pos) AS key
    FROM state a JOIN state b ON a.word = b.word AND a.pos + 1 = b.pos
    JOIN merges m ON m.l = a.id AND m.r = b.id GROUP BY a.word) best ON s.word = best.word
  WHERE s.pos <> (best.key & 4294967295) + 1),
final AS (SELECT word, max(step) AS step FROM state GROUP BY word)
SELECT word, pos, id FROM state JOIN final USING (word, step) ORDER BY word, pos"""

# Runs of overlapping candidates (a a a) are contracted at every other place from the left.
# A merged token that begins or ends a token of lower rank is contracted once a round only.
_LONG = f"""
WITH RECURSIVE state(word, pos, id, step) AS (
  SELECT word, pos, id, 0 FROM pieces
  UNION ALL
  SELECT word, (row_number() OVER (PARTITION BY word ORDER BY pos) - 1)::INTEGER, token, step + 1 FROM (
    SELECT word, pos, step, if(chosen, lowest::INTEGER, id) AS token,
      coalesce(lag(chosen) OVER (PARTITION BY word ORDER BY pos), false) AS gone
    FROM (SELECT *, here AND run % 2 = 1 AND (safe OR pos = min(if(here, pos, NULL)) OVER (PARTITION BY word)) AS chosen
      FROM (SELECT *, row_number() OVER (PARTITION BY word, island ORDER BY pos) AS run
        FROM (SELECT *, if(here, pos - row_number() OVER (PARTITION BY word, here ORDER BY pos), NULL) AS island
          FROM (SELECT p.*, coalesce(merged = lowest, false) AS here, lowest NOT IN (SELECT id FROM unsafe) AS safe
            FROM (SELECT n.word, n.pos, n.id, n.step, m.merged, min(m.merged) OVER (PARTITION BY n.word) AS lowest
              FROM (SELECT *, lead(id) OVER (PARTITION BY word ORDER BY pos) AS next FROM state) n
              LEFT JOIN merges m ON m.l = n.id AND m.r = n.next) p
            WHERE lowest IS NOT NULL AND step < {ROUNDS})))))
  WHERE NOT gone),
final AS (SELECT word, max(step) AS step FROM state GROUP BY word)
SELECT word, pos, id, step FROM state JOIN final USING (word, step) ORDER BY word, pos"""

_DECODE = """
SELECT doc, string_agg(piece, '') AS data FROM (
  SELECT doc, pos, piece FROM tokens JOIN vocabulary USING (id) ORDER BY doc, pos)
GROUP BY doc ORDER BY doc"""


class Codec:
    """Encodes and decodes with the ranks of a tiktoken file and its splitting pattern."""

    def __init__(self, ranks: bytes, pattern: str):
        import regex

        self.ranks = {
            base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines())
        }
        self.findall = regex.compile(pattern).findall
        # Ids of texts between two spaces, with the space before them, and of pieces.
        self.cut: Lately[str, bytes] = Lately(REMEMBERED)
        self.known: Lately[bytes, bytes] = Lately(REMEMBERED)
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        left, right, merged = [], [], []
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                a, b = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(rank)
        self.merges = {"l": pa.array(left, pa.int32()), "r": pa.array(right, pa.int32()), "merged": pa.array(merged, pa.int64())}
        # Bytes as the first 256 code points.
        self.vocabulary = {
            "id": pa.array(list(self.ranks.values()), pa.int32()),
            "piece": pa.array([t.decode("latin-1") for t in self.ranks], pa.string()),
        }
        self.db = None

    def _open(self) -> None:
        import duckdb

        # One thread, so that the sorted rows of a text are put together in their order.
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": MEMORY})
        self._table("merges", **self.merges)
        self._table("vocabulary", **self.vocabulary)
        self.db.execute(
            "CREATE TABLE unsafe AS SELECT DISTINCT greatest(l, r) AS id FROM merges WHERE merged < greatest(l, r)"
            " UNION SELECT DISTINCT least(l, r) FROM merges WHERE merged < least(l, r)"
        )

    def rest(self) -> None:
        """Give back DuckDB's memory between tasks; what is remembered stays."""
        if self.db is not None:
            self.db.close()
            self.db = None

    def _table(self, name: str, **columns) -> None:
        rows = pa.table(columns)
        self.db.register("rows", rows)
        self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM rows")
        self.db.unregister("rows")

    def _query(self, name: str, sql: str, **columns) -> pa.Table:
        if self.db is None:
            self._open()
        self.db.register(name, pa.table(columns))
        result = self.db.sql(sql).to_arrow_table()
        self.db.unregister(name)
        return result

    @staticmethod
    def _rows(ids: np.ndarray, lengths: np.ndarray) -> dict:
        starts = np.cumsum(lengths) - lengths
        return {
            "word": np.repeat(np.arange(len(lengths), dtype=np.int32), lengths),
            "pos": (np.arange(lengths.sum()) - np.repeat(starts, lengths)).astype(np.int32),
            "id": ids.astype(np.int32),
        }

    def _short(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of short pieces that are no tokens themselves."""
        lengths = np.array([len(p) for p in pieces])
        found = self._query("pieces", _SHORT, **self._rows(self.single[np.frombuffer(b"".join(pieces), np.uint8)], lengths))
        cuts = (4 * np.searchsorted(found["word"].to_numpy(), np.arange(len(pieces) + 1))).tolist()
        packed = found["id"].to_numpy().astype("<u4").tobytes()
        return [packed[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def _long(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of long pieces that are no tokens themselves."""
        state = [self.single[np.frombuffer(p, dtype=np.uint8)] for p in pieces]
        open_ = list(range(len(pieces)))
        while open_:
            some = [state[i] for i in open_]
            found = self._query("pieces", _LONG, **self._rows(np.concatenate(some), np.array([len(s) for s in some])))
            words, ids = found["word"].to_numpy(), found["id"].to_numpy()
            cuts = np.searchsorted(words, np.arange(len(open_) + 1))
            for k, i in enumerate(open_):
                state[i] = ids[cuts[k] : cuts[k + 1]]
            # Pieces whose rounds ran out go on from where they are.
            full = found["step"].to_numpy()[cuts[:-1]] == ROUNDS
            open_ = [i for k, i in enumerate(open_) if full[k]]
        return [s.astype("<u4").tobytes() for s in state]

    def _learn(self, pieces: set[bytes]) -> None:
        new = self.known.missing(pieces)
        whole = [p for p in new if p in self.ranks]
        self.known.update((p, self.ranks[p].to_bytes(4, "little")) for p in whole)
        rest = [p for p in new if p not in self.ranks]
        short = [p for p in rest if len(p) <= LONG]
        if short:
            self.known.update(zip(short, self._short(short), strict=True))
        some: list[bytes] = []
        for piece in [p for p in rest if len(p) > LONG]:
            if some and len(piece) + sum(map(len, some)) > LONG_AT_ONCE:
                self.known.update(zip(some, self._long(some), strict=True))
                some = []
            some.append(piece)
        if some:
            self.known.update(zip(some, self._long(some), strict=True))

    def encode(self, batch: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers.

        A piece never reaches across a space that a non-space follows, so texts are cut
        there first; what lies between two such spaces repeats more often than its parts.
        """
        cut = [_between_spaces(text) for text in batch]
        new = self.cut.missing(set().union(*cut))
        pieces = {c: [p.encode() for p in self.findall(c)] for c in new}
        self._learn(set().union(*pieces.values()))
        known = self.known.__getitem__
        self.cut.update((c, b"".join(map(known, p))) for c, p in pieces.items())
        ids = self.cut.__getitem__
        return [b"".join(map(ids, parts)) for parts in cut]

    def decode(self, batch: list[bytes]) -> list[bytes]:
        """The bytes of each sequence of ids."""
        ids = [np.frombuffer(b, dtype="<u4").astype(np.int32) for b in batch]
        lengths = np.array([len(i) for i in ids], dtype=np.int64)
        if not lengths.sum():
            return [b""] * len(batch)
        found = self._query(
            "tokens",
            _DECODE,
            doc=np.repeat(np.arange(len(ids), dtype=np.int32), lengths),
            pos=np.arange(lengths.sum(), dtype=np.int32),
            id=np.concatenate(ids),
        )
        result = [b""] * len(batch)
        for doc, data in zip(found["doc"].to_pylist(), found["data"].to_pylist(), strict=True):
            result[doc] = data.encode("latin-1")
        return result


def _between_spaces(text: str) -> list[str]:
    parts = text.split(" ")
    result = [parts[0]] if parts[0] else []
    hold = ""
    for part in parts[1:]:
        # A space before white space stays with what comes next but one.
        if not part or part[0].isspace():
            hold += " " + part
            if part and not part[-1].isspace():
                result.append(hold)
                hold = ""
        elif hold:
            result += [hold, " " + part]
            hold = ""
        else:
            result.append(" " + part)
    if hold:
        result.append(hold)
    return result


def codec(ranks: bytes, pattern: str) -> Codec:
    """This worker's codec; its memory of pieces serves all tasks of the worker."""
    key = ("codec", hashlib.sha256(ranks).digest(), pattern)
    return remembered(key, lambda: Codec(ranks, pattern))


def tokens(docs: DataFrame, path: str, pattern: str, keep: str = "digests") -> DataFrame:
    """One row per document, encoded with the ranks in ``path`` and decoded again.

    ``keep="digests"`` gives ``doc_id, n_tokens, ids_sha256, decoded_sha256``;
    ``keep="values"`` gives ``doc_id, ids`` (binary, little-endian unsigned 32-bit) and
    ``decoded`` (binary). A null text counts as empty and has no tokens. Special tokens do
    not exist. Rows that repeat an id are encoded each for itself; other columns are
    ignored. The rank file (one line per token, of fixed size) goes to every worker.
    """
    with open(path, "rb") as file:
        ranks = docs.sparkSession.sparkContext.broadcast(file.read())
    values = keep == "values"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(ranks.value, pattern)
        try:
            for batch in batches:
                done = 0
                for some in slices((v.as_py() for v in batch.column("text")), AT_ONCE):
                    with without_collection():
                        ids = coder.encode(some)
                        decoded = coder.decode(ids)
                    result = {"doc_id": batch.column("doc_id").slice(done, len(some))}
                    done += len(some)
                    if values:
                        result |= {"ids": pa.array(ids, pa.binary()), "decoded": pa.array(decoded, pa.binary())}
                    else:
                        result["n_tokens"] = pa.array([len(i) // 4 for i in ids], pa.int64())
                        for name, data in (("ids_sha256", ids), ("decoded_sha256", decoded)):
                            result[name] = pa.array([hashlib.sha256(d).hexdigest() for d in data], pa.string())
                    yield pa.RecordBatch.from_pydict(result)
        finally:
            coder.rest()

    frame = texts(docs)
    columns = "ids binary, decoded binary" if values else "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return frame.mapInArrow(rows, f"doc_id {dict(frame.dtypes)['doc_id']}, {columns}")
