"""Alignment against the two libraries on whole texts, one pair of tokens at a time."""

import base64
import hashlib
from collections import Counter

import pytest
from helpers import clashing, docs

from kinrank.llm import alignment as al

public_tokenizers = pytest.importorskip("public_tokenizers")
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")

TEXTS = [
    None, "", " ", "  ", "a", "a ", " a", "a  b", "a\nb\n", "\n", "tab\tand\r\nline", "don't we'll 123 4567!",
    "Größe naïve façade ﬁn ½ Ⅷ", "日本語のテキスト と 空白", "👍🏽 ok 👩‍👩‍👧", "𒀀𒁹 cuneiform", "é combining",
    "U+2581 ▁ inside", "▁", "<|endoftext|> and <s> </s> <unk> <0x0A>", "nul\x00byte \x7f", "nbsp here  em",
    "​zero width ﻿bom", "x" * 3000, "word " * 2000, "aé" * 700, "a" * 60 + " " + "b" * 70 + "  c",
    "᠎ mongolian ᠎", "ends with spaces   ", "İstanbul ſ ß ẞ", "a a a a a", "퟿ private",
]


class Libraries:
    @staticmethod
    def load():
        import sentencepiece
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(A)
        tokenizer.encode_special_tokens = True
        model = sentencepiece.SentencePieceProcessor(model_file=B)
        with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
            ranks = {int(k): base64.b64decode(t) for t, k in map(bytes.split, file)}
        return tokenizer, model, ranks


@pytest.fixture(scope="module")
def libraries():
    return Libraries.load()


def plain(libraries, texts):
    """Every pair of occurrences is looked at; bytes of A come from the rank file."""
    tokenizer, model, ranks = libraries
    rows = []
    for text in texts:
        whole = (" " + (text or "")).encode()
        a = [(k, ranks[k]) for k in tokenizer.encode(" " + (text or ""), add_special_tokens=False).ids]
        b = []
        for k in model.encode(text or ""):
            piece = model.id_to_piece(k)
            b.append((k, bytes([int(piece[3:5], 16)]) if model.is_byte(k) else piece.replace("▁", " ").encode()))
        if not text or b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
            rows.append(None)
            continue

        def ends(tokens):
            found, at = [], 0
            for k, data in tokens:
                at += len(data)
                found.append((at, k))
            return found

        a, b = ends(a), ends(b)
        cuts = sorted({e for e, _ in a} & {e for e, _ in b})
        groups, low = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(k) for e, k in side if low < e <= cut) for side in (a, b)))
            low = cut
        by_end = dict(b)
        links = [(k, by_end[e]) for e, k in a if e in by_end]
        rows.append((len(a), len(b), len(cuts), ";".join(groups), links))
    counts = Counter(link for row in rows if row for link in row[4])
    most = {}
    for (_, k), n in counts.items():
        most[k] = max(most.get(k, 0), n)
    return [
        (0, 0, 0, 0, 0, 0, "")
        if row is None
        else (
            *row[:3],
            len(row[4]),
            sum(counts[link] == most[link[1]] for link in row[4]),
            sum(counts[link] for link in row[4]),
            hashlib.sha256(row[3].encode()).hexdigest(),
        )
        for row in rows
    ]


def run(frame):
    return {r[0]: tuple(r)[1:] for r in al.alignment(frame, A, B).collect()}


def test_awkward_texts(spark, libraries):
    got = run(clashing(docs(spark, enumerate(TEXTS)).selectExpr("*", "1 AS n_a", "2 AS links", "3 AS pair")))
    assert [got[k] for k in range(len(TEXTS))] == plain(libraries, TEXTS)


def test_documents(spark, libraries, folder):
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {r.doc_id: r.text for r in frame.collect()}
    got = run(frame)
    assert [got[k] for k in texts] == plain(libraries, texts.values())


def test_repeated_rows_null_ids_and_no_rows(spark, libraries):
    rows = [(1, "same words"), (1, "same words"), (None, "other words"), (2, None)]
    got = sorted(map(tuple, al.alignment(docs(spark, rows), A, B).collect()), key=str)
    want = [(i, *row) for (i, _), row in zip(rows, plain(libraries, [t for _, t in rows]))]
    assert got == sorted(want, key=str)
    assert al.alignment(docs(spark, []), A, B).collect() == []


def test_groups_are_real_outputs(spark):
    (row,) = al.aligned_texts(docs(spark, [(1, "Hello world")]), A, B, keep_groups=True).collect()
    groups = row.groups.split(";")
    assert row.n_groups == len(groups) == len(row.links)
    assert hashlib.sha256(row.groups.encode()).hexdigest() == row.groups_sha256


def test_stretches_change_nothing():
    """Whole texts at once give what stretches give."""
    with open(A, encoding="utf-8") as one, open(B, "rb") as other:
        definition, model = one.read(), other.read()
    parted, whole = al.Aligner(definition, model), al.Aligner(definition, model)
    assert parted.b.splits
    whole.b.splits = False
    texts = [t or "" for t in TEXTS]
    assert parted.align(texts) == whole.align(texts)
    assert parted.align(texts) == whole.align(texts)


def test_forgetting_changes_nothing(monkeypatch):
    with open(A, encoding="utf-8") as one, open(B, "rb") as other:
        definition, model = one.read(), other.read()
    keeping, forgetting = al.Aligner(definition, model), al.Aligner(definition, model)
    texts = [t or "" for t in TEXTS]
    want = keeping.align(texts)
    monkeypatch.setattr(al, "REMEMBERED", 3)
    assert [forgetting.align([t])[0] for t in texts] == want
    assert [forgetting.align([t])[0] for t in reversed(texts)] == want[::-1]


def test_pairs_are_bounded_by_the_vocabularies():
    assert al.pair_bound([b"ab", b"b", b"c"], [b"b", b"ab", b"xc"]) == 5
