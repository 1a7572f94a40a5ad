"""Exact copies against plain grouping, with collisions forced and every odd input."""

import hashlib
import random

import pytest
from helpers import clashing, docs

from kinrank.llm.exact_dedup import (
    Fingerprinter,
    exact_groups,
    same_text,
    without_exact_copies,
)


def brute(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(text or "", []).append(doc_id)
    return sorted(
        (i, max(ids), len(ids), hashlib.sha256(t.encode()).hexdigest())
        for t, ids in groups.items()
        for i in ids
    )


def found(frame):
    return sorted((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in frame.collect())


ROWS = [(1, "a"), (2, "b"), (3, "a"), (4, None), (5, ""), (6, "a "), (7, "é🙂"), (8, "é🙂")]
ROWS += [(9, "x" * 50_000 + "y"), (10, "x" * 50_000 + "y"), (11, "x" * 50_000 + "z")]


def test_groups_agree_with_plain_grouping(spark):
    result = exact_groups(clashing(docs(spark, ROWS)))
    assert found(result) == brute(ROWS)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in result.collect())


@pytest.mark.parametrize("group_rows", [2, 20_000])
def test_collisions_and_salted_groups_stay_apart(spark, group_rows):
    random.seed(1)
    rows = [(i, random.choice("abcdefgh") * 3) for i in range(120)]
    weak = Fingerprinter(moduli=(2, 3))
    assert found(exact_groups(docs(spark, rows), weak, group_rows)) == brute(rows)


def test_one_of_repeated_rows_is_kept(spark):
    rows = [(1, "a"), (1, "a"), (1, "a"), (2, "b"), (2, "c"), (None, "a"), (None, "d")]
    result = exact_groups(docs(spark, rows)).collect()
    kept = sorted(((r.doc_id, r.group_size) for r in result if r.kept), key=str)
    assert len(result) == 7
    assert kept == [(1, 4), (2, 1), (2, 1), (None, 1)]


def test_filter_keeps_columns_and_one_row_of_each_group(spark):
    frame = clashing(docs(spark, [*ROWS, (10, "x" * 50_000 + "y"), (None, "n")]))
    left = without_exact_copies(frame)
    assert left.columns == frame.columns
    assert sorted((r.doc_id for r in left.collect()), key=str) == sorted([2, 3, 5, 6, 8, 10, 11, None], key=str)


def test_no_rows(spark):
    assert exact_groups(docs(spark, [])).count() == 0
    assert without_exact_copies(docs(spark, [])).count() == 0


def test_any_cut_gives_the_same_fingerprint():
    make = Fingerprinter(chunk=64)
    data = random.Random(2).randbytes(1000)
    for cut in (0, 1, 63, 64, 65, 500, 1000):
        assert make.combine(make(data[:cut]), make(data[cut:])) == make(data)
    slow = [len(data)]
    for b, m in zip((1_000_003, 715_827_883), make.moduli, strict=True):
        slow.append(sum((x + 1) * pow(b, i, m) for i, x in enumerate(data)) % m)
    assert make(data) == tuple(slow)


def test_comparison_by_chunks():
    a = memoryview(b"ab" * 5000)
    assert same_text(a, memoryview(b"ab" * 5000))
    assert not same_text(a, memoryview(b"ab" * 4999 + b"ac"))
    assert not same_text(a, a[:-1])
