"""Shards against splitting by hand."""

import hashlib

from helpers import clashing, docs

from kinrank.llm.sharding import shards


def brute(rows, limit):
    bits = {}
    for doc_id, _ in rows:
        name = "" if doc_id is None else str(doc_id)
        bits[doc_id] = format(int(hashlib.md5(name.encode()).hexdigest()[:15], 16), "060b")
    size = lambda t: len((t or "").encode())
    result = []
    for doc_id, _ in rows:
        for depth in range(61):
            inside = [size(t) for d, t in rows if bits[d][:depth] == bits[doc_id][:depth]]
            if sum(inside) <= limit or depth == 60:
                result.append((doc_id, bits[doc_id][:depth], depth, sum(inside), len(inside), sum(inside) <= limit))
                break
    return sorted(result, key=str)


def test_only_oversized_buckets_split(spark):
    rows = [(i, "é" * (i % 7)) for i in range(120)]
    found = shards(clashing(docs(spark, rows)), 40)
    assert sorted(map(tuple, found.collect()), key=str) == brute(rows, 40)


def test_what_cannot_fit_is_said(spark):
    """One document over the limit, a repeated id, nulls; the directory grows to the end."""
    rows = [(1, "x" * 100), (2, "y" * 8), (2, "y" * 8), (3, None), (None, "z"), (None, ""), (4, "w" * 10)]
    found = sorted(map(tuple, shards(docs(spark, rows), 12).collect()), key=str)
    assert found == brute(rows, 12)
    assert {r[0] for r in found if not r[5]} == {1, 2}


def test_one_shard_and_none(spark):
    assert [r.shard for r in shards(docs(spark, [(1, "a"), (2, "b")])).collect()] == ["", ""]
    assert shards(docs(spark, [])).count() == 0
