"""Files of token ids: packing, random access, and the tokenizers library."""

import io
import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import clashing, docs

from kinrank.llm import token_files as tf

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("bits", [1, 3, 8, 13, 16, 17, 20])
def test_packing_is_exact(bits):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 999, dtype=np.uint32)
    data = tf.pack(ids, bits)
    assert len(data) == -(-999 * bits // 8)
    assert (tf.unpack(data, bits, 999) == ids).all()


def test_widths():
    assert [tf.bits_for(n) for n in (1, 2, 3, 256, 257, 49_408)] == [1, 1, 2, 8, 9, 16]
    with pytest.raises(ValueError):
        tf.pack(np.array([8], dtype=np.uint32), 3)


def test_random_access():
    sink = io.BytesIO()
    writer = tf.Writer(sink, 11, block=16)
    rng = np.random.default_rng(5)
    lists = [rng.integers(0, 2**11, n, dtype=np.uint32) for n in (0, 1, 16, 17, 500, 0, 3)]
    for k, ids in enumerate(lists):
        writer.add(k if k else None, ids)
    writer.close()
    reader = tf.Reader.open(_source(sink.getvalue()))
    assert reader.docs == [None, 1, 2, 3, 4, 5, 6]
    whole = np.concatenate(lists)
    for start, stop in ((0, 0), (0, len(whole)), (15, 17), (16, 16), (31, 33), (530, 537)):
        assert (reader.ids(start, stop) == whole[start:stop]).all()
    for k, ids in enumerate(lists):
        assert (reader.document(k) == ids).all()
    assert reader.checksums().tolist() == [zlib.crc32(x.astype("<u4").tobytes()) for x in lists]
    with pytest.raises(IndexError):
        reader.ids(0, len(whole) + 1)


def _source(data):
    return pa.PythonFile(io.BytesIO(data), mode="r")


def test_documents_round_trip(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(PATH)
    library.encode_special_tokens = True
    rows = [(5, "Hello World, it's\n\tfine"), (3, None), (4, ""), (9, "word " * 5000), (7, "É <|endoftext|>"), (5, "twice"), (None, "no id")]
    folder = tf.token_folder(spark)
    files = tf.write_tokens(clashing(docs(spark, rows)), folder, PATH, 49_408)
    found = sorted(tf.read_tokens(files, folder, keep_ids=True).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == [None, 3, 4, 5, 5, 7, 9]
    expected = {}
    for doc_id, text in rows:
        expected.setdefault(doc_id, []).append(library.encode(text or "", add_special_tokens=False).ids + [1])
    start = 0
    for r in found:
        assert r.ids in expected[r.doc_id] and r.start == start and r.n_tokens == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes())
        start += r.n_tokens


def test_added_tokens_as_the_library_has_them(spark, tmp_path):
    from tokenizers import Tokenizer

    from kinrank.llm.queries import QUERIES

    library = Tokenizer.from_file(PATH)
    texts = [
        "a <|endoftext|> b", "a<|endoftext|>b", "<|startoftext|>Hello<|endoftext|>", "<|EndOfText|>, x", "<|endoftext|",
        "é<|endoftext|>é it's", "<|endoftext|>\u0338", "🙂<|endoftext|>\r\n<|startoftext|>\t1", "<|endoftext|>" * 9, "plain",
    ]
    docs(spark, enumerate(texts)).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: tuple(r)[1:] for r in QUERIES["op7_token_files"](spark, str(tmp_path)).collect()}
    start = 0
    for k, text in enumerate(texts):
        ids = np.array(library.encode(text, add_special_tokens=False).ids + [1], dtype="<u4")
        assert found.pop(k) == (start, len(ids), zlib.crc32(ids.tobytes())), text
        start += len(ids)
    assert not found


def test_no_rows(spark):
    folder = tf.token_folder(spark)
    files = tf.write_tokens(docs(spark, []), folder, PATH, 49_408)
    assert tf.read_tokens(files, folder).count() == 0
