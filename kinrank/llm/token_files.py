"""Token ids in fixed-width bit-packed files.

A file holds the ids of consecutive documents, each id in the fewest bits that the
vocabulary needs, in blocks of ``BLOCK`` ids that begin on a byte. Behind the blocks stand
their offsets, where each document's ids begin, and the document ids; a trailer of fixed
size says where. A reader thus takes any range of ids from the blocks around it, and numpy
unpacks a block at once. Files are in ascending order of documents, as their names are.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinrank.llm.tables import texts
from kinrank.llm.worker import remembered, slices, without_collection
from kinrank.session import ensure_checkpoint_dir

BLOCK = 4096
MAGIC = b"IDBLOCKS"
# magic, bits, ids a block, documents, ids, place of the offsets
TRAILER = "<8sIIQQQ"
# Blocks packed or unpacked at once.
SPAN = 64
# Words, and runs of letters, that a worker remembers; characters it works on at once.
REMEMBERED = 400_000
AT_ONCE = 1 << 20
# Latin-1 letters, each one character in every normal form of composed text.
LATIN = "À-ÖØ-öø-ÿ"


def bits_for(vocabulary: int) -> int:
    """The fewest bits, at least one, that hold ids below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids one behind the other, least significant bit first, padded to a byte."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id needs more than {bits} bits")
    places = np.arange(bits, dtype=np.uint32)
    return np.packbits(((ids[:, None] >> places) & 1).astype(np.uint8), bitorder="little").tobytes()


def unpack(data: bytes, bits: int, count: int) -> np.ndarray:
    flat = np.unpackbits(np.frombuffer(data, dtype=np.uint8), count=count * bits, bitorder="little")
    weights = 2.0 ** np.arange(bits)
    return (flat.reshape(count, bits) @ weights).astype("<u4")


def open_store(uri: str) -> tuple[FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return FileSystem.from_uri(uri)


class Writer:
    """Appends documents to one file."""

    def __init__(self, sink, bits: int, block: int = BLOCK):
        self.sink, self.bits, self.block = sink, bits, block
        self.waiting: list[np.ndarray] = []
        self.held = self.ids = self.at = 0
        self.offsets: list[int] = []
        self.starts: list[int] = []
        self.docs: list[int | None] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id)
        self.starts.append(self.ids)
        self.ids += len(ids)
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= SPAN * self.block:
            self._flush(self.held // self.block * self.block)

    def _flush(self, count: int) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, dtype="<u4")
        for start in range(0, count, self.block):
            data = pack(ids[start : min(start + self.block, count)], self.bits)
            self.offsets.append(self.at)
            self.sink.write(data)
            self.at += len(data)
        self.waiting = [ids[count:]]
        self.held = len(ids) - count

    def close(self) -> None:
        self._flush(self.held)
        self.sink.write(np.array([*self.offsets, self.at], dtype="<u8").tobytes())
        self.sink.write(np.array([*self.starts, self.ids], dtype="<u8").tobytes())
        self.sink.write(np.array([d or 0 for d in self.docs], dtype="<i8").tobytes())
        self.sink.write(np.array([d is None for d in self.docs], dtype=np.uint8).tobytes())
        self.sink.write(struct.pack(TRAILER, MAGIC, self.bits, self.block, len(self.docs), self.ids, self.at))


@dataclass
class Reader:
    """Random access to one file."""

    source: object
    bits: int
    block: int
    offsets: np.ndarray
    starts: np.ndarray
    docs: list[int | None]

    @classmethod
    def open(cls, source) -> Reader:
        size, length = source.size(), struct.calcsize(TRAILER)
        magic, bits, block, n_docs, n_ids, at = struct.unpack(TRAILER, source.read_at(length, size - length))
        if magic != MAGIC:
            raise ValueError("not a file of token ids")
        tail = source.read_at(size - length - at, at)
        n_blocks = -(-n_ids // block)
        cuts = np.cumsum([0, 8 * (n_blocks + 1), 8 * (n_docs + 1), 8 * n_docs, n_docs])
        parts = [tail[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        nulls = np.frombuffer(parts[3], dtype=np.uint8)
        docs = [None if null else int(d) for d, null in zip(np.frombuffer(parts[2], "<i8"), nulls, strict=True)]
        return cls(source, bits, block, np.frombuffer(parts[0], "<u8"), np.frombuffer(parts[1], "<u8"), docs)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The ids from ``start`` up to ``stop``, from the blocks that hold them alone."""
        start, stop, total = int(start), int(stop), int(self.starts[-1])
        if not 0 <= start <= stop <= total:
            raise IndexError(f"{start}..{stop} of {total} ids")
        if start == stop:
            return np.zeros(0, dtype="<u4")
        first, last = start // self.block, (stop - 1) // self.block
        at = int(self.offsets[first])
        data = self.source.read_at(int(self.offsets[last + 1]) - at, at)
        parts = []
        for k in range(first, last + 1):
            count = min(self.block, total - k * self.block)
            parts.append(unpack(data[int(self.offsets[k]) - at : int(self.offsets[k + 1]) - at], self.bits, count))
        return np.concatenate(parts)[start - first * self.block : stop - first * self.block]

    def document(self, k: int) -> np.ndarray:
        return self.ids(self.starts[k], self.starts[k + 1])

    def checksums(self) -> np.ndarray:
        """The CRC-32 of each document's ids as unsigned 32-bit integers, in one pass."""
        found = np.zeros(len(self.docs), dtype=np.int64)
        step, total = SPAN * self.block, int(self.starts[-1])
        for low in range(0, total, step):
            high = min(low + step, total)
            data = memoryview(self.ids(low, high).tobytes())
            k = int(np.searchsorted(self.starts, low, side="right")) - 1
            while k < len(self.docs) and self.starts[k] < high:
                a, b = max(low, int(self.starts[k])), min(high, int(self.starts[k + 1]))
                if a < b:
                    found[k] = zlib.crc32(data[4 * (a - low) : 4 * (b - low)], int(found[k]))
                k += 1
        return found


class WordEncoder:
    """Ids of texts by the tokenizers library, which drops white space.

    What lies between spaces, tabs and line ends is encoded once and remembered. If it is
    plain (ASCII but for the apostrophe, and single-character Latin-1 letters), the library
    always parts it where letters meet other characters, so runs of letters are remembered,
    too, in lower case, and go to the library's BPE model directly. All else goes through
    the whole tokenizer. With ``added`` the tokens added to the vocabulary get their ids where
    a text holds them, as the library does by itself, and words with one go through the whole
    tokenizer; without, such strings are ordinary text.
    """

    def __init__(self, definition: str, added: bool = False):
        # One thread: the cores belong to other tasks.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.encode_special_tokens = not added
        # They may be found in normalised text, so in lower case, too.
        contents = [t["content"].lower() for t in json.loads(definition).get("added_tokens") or []]
        self.added = re.compile("|".join(map(re.escape, contents))).search if added and contents else None
        self.model = self.tokenizer.model
        self.plain = re.compile(f"[!-&(-~{LATIN}]*").fullmatch
        self.runs = re.compile(f"[A-Za-z{LATIN}]+|[^A-Za-z{LATIN}]+").findall
        # How the library writes the bytes of a letter.
        latin = [chr(c) for c in range(0xC0, 0x100) if chr(c).isalpha() and re.match(f"[{LATIN}]", chr(c))]
        self.written = str.maketrans({c: self.tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in latin})
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.packed = [i.to_bytes(4, "little") for i in range(size)]
        self.known: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _library(self, words: list[str]) -> list[bytes]:
        found = []
        for start in range(0, len(words), 1024):
            some = self.tokenizer.encode_batch_fast(words[start : start + 1024], add_special_tokens=False)
            found += [np.array(f.ids, dtype="<u4").tobytes() for f in some]
        return found

    def _runs(self, word: str) -> list[str] | None:
        """The runs of a plain word in lower case, or None."""
        if word.isascii():
            if "'" in word or not word.isprintable():
                return None
        elif not self.plain(word):
            return None
        if self.added and self.added(word.lower()):
            return None
        return [word.lower()] if word.isalpha() else self.runs(word.lower())

    def _learn(self, words: Iterable[str]) -> None:
        runs = {word: self._runs(word) for word in words}
        whole = [word for word, found in runs.items() if found is None]
        self.known.update(zip(whole, self._library(whole), strict=True))
        for word in whole:
            del runs[word]
        other = []
        for run in set(chain.from_iterable(runs.values())) - self.parts.keys():
            if run[0].isalpha():
                spelt = run if run.isascii() else run.translate(self.written)
                self.parts[run] = b"".join([self.packed[t.id] for t in self.model.tokenize(spelt)])
            else:
                other.append(run)
        self.parts.update(zip(other, self._library(other), strict=True))
        parts, known = self.parts, self.known
        for word, found in runs.items():
            known[word] = parts[found[0]] if len(found) == 1 else b"".join([parts[r] for r in found])

    def encode(self, batch: list[str]) -> list[bytes]:
        for memory in (self.known, self.parts):
            if len(memory) > REMEMBERED:
                memory.clear()
        words = [text.replace("\n", " ").replace("\t", " ").split(" ") for text in batch]
        self._learn(set().union(*words) - self.known.keys())
        ids = self.known.__getitem__
        return [b"".join(map(ids, w)) for w in words]


def _encoder(definition: str, added: bool) -> WordEncoder:
    key = ("words", added, hashlib.sha256(definition.encode()).digest())
    return remembered(key, lambda: WordEncoder(definition, added))


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, vocabulary: int, end: int = 1, added: bool = False
) -> DataFrame:
    """Encode all documents, each closed by the id ``end``, into files under ``folder``.

    ``tokenizer`` is the path of a tokenizers definition. Returns one row per file, in order:
    ``file, n_docs, n_ids, start``. Documents are in ascending order of ``doc_id`` (nulls
    first; rows that repeat an id by their text). Strings like the definition's added tokens are
    ordinary text, or those tokens with ``added``, the library's own way. A null or empty text is the end id alone.
    A file appears under its name when it is complete, so a task that runs again only
    replaces it by the same bytes.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as file:
        definition = spark.sparkContext.broadcast(file.read())
    bits, closing = bits_for(vocabulary), np.array([end], dtype="<u4").tobytes()
    store, place = open_store(folder)
    store.create_dir(place, recursive=True)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, context = _encoder(definition.value, added), TaskContext.get()
        store, place = open_store(folder)
        name = f"{place}/part-{context.partitionId():07d}.ids"
        draft = f"{place}/.{context.partitionId()}-{context.taskAttemptId()}"
        writer = None
        with store.open_output_stream(draft) as sink:
            writer = Writer(sink, bits)
            for batch in batches:
                ids_of_docs = iter(batch.column("doc_id").to_pylist())
                for some in slices((v.as_py() for v in batch.column("text")), AT_ONCE):
                    with without_collection():
                        found = encoder.encode(some)
                    for ids in found:
                        writer.add(next(ids_of_docs), np.frombuffer(ids + closing, dtype="<u4"))
            writer.close()
        store.move(draft, name)
        yield pa.RecordBatch.from_pydict(
            {"file": [name.rpartition("/")[2]], "n_docs": [len(writer.docs)], "n_ids": [writer.ids]}
        )

    tie = F.xxhash64("text")
    ordered = (
        texts(docs)
        .withColumn("doc_id", F.col("doc_id").cast("bigint"))
        .repartitionByRange("doc_id", tie)
        .sortWithinPartitions("doc_id", tie)
    )
    # One row for each file.
    files = sorted(map(tuple, ordered.mapInArrow(rows, "file string, n_docs bigint, n_ids bigint").collect()))
    start, placed = 0, []
    for file, n_docs, n_ids in files:
        placed.append((file, n_docs, n_ids, start))
        start += n_ids
    return spark.createDataFrame(placed, "file string, n_docs bigint, n_ids bigint, start bigint")


def read_tokens(files: DataFrame, folder: str, keep_ids: bool = False) -> DataFrame:
    """One row per document: ``doc_id, start, n_tokens, ids_crc32`` (and ``ids``), read back.

    ``start`` counts the ids of all documents before, over all files.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = open_store(folder)
        for batch in batches:
            for file, begin in zip(*(batch.column(c).to_pylist() for c in ("file", "start")), strict=True):
                with store.open_input_file(f"{place}/{file}") as source:
                    reader = Reader.open(source)
                    starts = reader.starts.astype(np.int64)
                    result = {
                        "doc_id": pa.array(reader.docs, pa.int64()),
                        "start": pa.array(starts[:-1] + begin),
                        "n_tokens": pa.array(np.diff(starts)),
                        "ids_crc32": pa.array(reader.checksums()),
                    }
                    whole = pa.RecordBatch.from_pydict(result)
                    for k in range(0, whole.num_rows, 1000):
                        part = whole.slice(k, 1000)
                        if keep_ids:
                            ids = [reader.document(i).tolist() for i in range(k, k + part.num_rows)]
                            part = part.append_column("ids", pa.array(ids, pa.list_(pa.int64())))
                        yield part

    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    count = max(1, files.count())
    spread = files.repartition(count, "file")
    return spread.mapInArrow(rows, schema + ", ids array<bigint>" * keep_ids)


def token_folder(spark: SparkSession) -> str:
    """A new folder beside the checkpoints, which all executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/ids-{uuid.uuid4().hex}"
