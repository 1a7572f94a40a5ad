"""Ids against the tiktoken library, and exact round trips."""

import base64
import hashlib
import random

import numpy as np
import pytest
from helpers import clashing, docs

from kinrank.llm.bpe import ROUNDS, Codec, tokens

public_tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def library(raw, pattern=public_tokenizers.PATTERN):
    ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, raw.splitlines())}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def raw():
    with open(PATH, "rb") as file:
        return file.read()


@pytest.fixture(scope="module")
def codec(raw):
    return Codec(raw, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def encoding(raw):
    return library(raw)


def agree(codec, encoding, texts):
    found = codec.encode(texts)
    assert [np.frombuffer(f, "<u4").tolist() for f in found] == [encoding.encode_ordinary(t) for t in texts]
    assert codec.decode(found) == [t.encode() for t in texts]


def test_short_random_texts(codec, encoding):
    draw = random.Random(2)
    signs = " \n\t  ab.'sé!1  　\xa0漢🙂"
    agree(codec, encoding, ["".join(draw.choices(signs, k=draw.randint(0, 30))) for _ in range(2000)])


def test_words_and_special_strings(codec, encoding):
    agree(codec, encoding, ["", " ", "a", "don't  stop ", "<|endoftext|> x", "Überraschung, ñandú éèê\r\n", "the " * 500])


def test_long_pieces(codec, encoding):
    draw = random.Random(3)
    agree(codec, encoding, ["a" * 3000, " " * 700 + "x", "ab" * 400, "".join(draw.choices("etaoin", k=300)), "ab" * 32 + "c"])


def test_overlapping_pairs_and_tokens_of_lower_rank():
    """Ranks made so that a merge opens a pair of lower rank, and runs overlap."""
    parts = [bytes([b]) for b in range(256)] + [b"aa", b"abc", b"bc", b"aaa", b"bcbc", b"cab", b"aab", b"caa"]
    made = b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate(parts))
    pattern = r"\S+|\s+"
    draw = random.Random(4)
    texts = ["".join(draw.choices("abc", k=draw.choice([3, 10, 70, 200]))) for _ in range(150)]
    agree(Codec(made, pattern), library(made, pattern), texts)


def test_more_rounds_than_one_query_makes():
    """A chain of merges longer than a recursive query goes."""
    word = bytes(range(97, 123)) * 4
    parts = [bytes([b]) for b in range(256)] + [word[:n] for n in range(2, ROUNDS * 3)]
    made = b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate(parts))
    agree(Codec(made, r"\S+"), library(made, r"\S+"), [(word + b"!").decode()])


def test_documents(spark, raw, encoding):
    rows = [(1, "Hello  world"), (2, None), (3, ""), (4, "x y" * 9000), (1, "again"), (None, "é")]
    frame = clashing(docs(spark, rows))
    found = tokens(frame, PATH, public_tokenizers.PATTERN)
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    expected = []
    for doc_id, text in rows:
        ids = encoding.encode_ordinary(text or "")
        data = np.array(ids, dtype="<u4").tobytes()
        expected.append((doc_id, len(ids), hashlib.sha256(data).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)
    values = tokens(frame, PATH, public_tokenizers.PATTERN, keep="values").collect()
    assert sorted(bytes(r.decoded) for r in values) == sorted((t or "").encode() for _, t in rows)


def test_no_rows(spark):
    assert tokens(docs(spark, []), PATH, public_tokenizers.PATTERN).count() == 0


def test_what_is_met_again_is_remembered():
    from kinrank.llm.worker import Lately

    memory = Lately(2)
    for round_ in range(20):
        new = memory.missing({"often", f"once{round_}"})
        assert ("often" in new) == (round_ == 0)
        memory.update((k, k.upper()) for k in new)
        assert memory["often"] == "OFTEN" and len(memory) + len(memory.before) <= 6
