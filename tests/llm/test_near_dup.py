"""Near-copies against all pairs, in groups that pivots alone cannot decide."""

import random
import re

import numpy as np
import pytest
from helpers import clashing, docs

from kinrank.llm import near_dup
from kinrank.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return set()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


def brute(rows, width, percent=80):
    sets = {i: shingles(t, width) for i, t in rows}
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                label[max(x, y)] = min(x, y)
    return sorted((i, len(sets[i]), root(i), root(i) == i) for i in ids)


def changed(words, count, rng):
    words = list(words)
    for i in rng.sample(range(len(words)), count):
        words[i] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def chains(seed):
    rng = random.Random(seed)
    rows, n = [], 0
    for _ in range(12):
        base = [f"v{rng.randrange(300)}" for _ in range(rng.choice([6, 40, 120]))]
        rows.append((n, " ".join(base)))
        n += 1
        # Copies near the threshold: some are linked with each other only by way of others.
        for _ in range(rng.choice([1, 3, 25])):
            rows.append((n, changed(base, rng.randrange(0, max(1, len(base) // 12) + 1), rng)))
            n += 1
    rows += [(n, None), (n + 1, ""), (n + 2, " \t\n"), (n + 3, "one"), (n + 4, "ONE"), (n + 5, "x " * 30_000)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("width", [2, 5])
def test_components_agree_with_all_pairs(spark, width):
    rows = chains(width)
    result = near_dup.near_copies(clashing(docs(spark, rows)), width)
    assert sorted(map(tuple, result.collect())) == brute(rows, width)


@pytest.mark.parametrize("listed", [0, 4, 10**6])
def test_what_pivots_leave_is_compared_in_full(spark, monkeypatch, listed):
    monkeypatch.setattr(near_dup, "PIVOTS", 0)
    rows = chains(7)
    result = near_dup.near_copies(docs(spark, rows), 2, listed=listed)
    assert sorted(map(tuple, result.collect())) == brute(rows, 2)


def test_repeated_and_null_ids(spark):
    a, b = " ".join(f"a{i}" for i in range(50)), " ".join(f"b{i}" for i in range(50))
    rows = [(5, a), (5, b), (7, a + " x"), (9, b + " y"), (9, b + " y"), (None, a), (3, "alone here")]
    result = sorted(map(tuple, near_dup.near_copies(docs(spark, rows), 2).collect()), key=str)
    assert [(r[0], r[2], r[3]) for r in result] == [
        (3, 3, True), (5, 5, True), (5, 5, True), (7, 5, False), (9, 5, False), (9, 5, False), (None, None, True),
    ]


def test_filter_keeps_columns(spark):
    rows = [(1, "a b c d e f g h"), (2, "A b c d e f g h"), (3, None), (4, None)]
    frame = clashing(docs(spark, rows))
    left = near_dup.without_near_copies(frame)
    assert left.columns == frame.columns
    assert sorted(r.doc_id for r in left.collect()) == [1, 3, 4]


def test_no_rows(spark):
    assert near_dup.near_copies(docs(spark, []), 2).count() == 0
    assert near_dup.without_near_copies(docs(spark, [])).count() == 0


def test_words_do_not_depend_on_their_place():
    shingler = near_dup.Shingler(2)
    words = [b"alpha", b"b", b"\xc3\xa9t\xc3\xa9", b"x" * 70_000, b"alpha", b"b"] * 40_000
    data = b" ".join(words[:9]) + b"\n\t " + b" ".join(w for w in words if len(w) < 9)
    found = shingler.words(data)
    names = data.split()
    assert len(found) == len(names)
    by_name = {}
    for name, value in zip(names, found.tolist(), strict=True):
        assert by_name.setdefault(name, value) == value
    assert len(set(by_name.values())) == len(by_name)


def test_keys_meet_by_pigeonhole():
    signer = near_dup.Signer()
    rng = np.random.default_rng(1)
    for _ in range(50):
        one = rng.integers(0, 2**16, (signer.chunks, signer.length), dtype=np.uint64)
        other = one.copy()
        for place in rng.permutation(one.size)[: 2 * signer.chunks - 1]:
            other.flat[place] += np.uint64(1)
        assert set(signer.keys(one)) & set(signer.keys(other))


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 200), (None, 1), (300, None)]
    result = {r.node: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert result == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}}


def framed(n, own, seed):
    """Texts with one frame and words of their own: many keys in common, no links."""
    rng = random.Random(seed)
    frame = [f"f{i}" for i in range(150)]
    rows = []
    for k in range(n):
        words = list(frame)
        for at in sorted(rng.sample(range(150), own), reverse=True):
            words.insert(at, f"w{k}x{at}")
        rows.append((k, " ".join(words)))
    return rows


def test_unlinked_groups_take_rows_in_proportion(spark):
    """Twice the texts of one group make twice the rows, not four times."""
    rows_made = []
    for n in (60, 120):
        frame = docs(spark, framed(n, 14, 3))
        sets = near_dup._sets(frame, 2).cache()
        ids = frame.select(frame.doc_id.alias("doc"))
        labels = ids.selectExpr("doc", "doc AS label")
        rare = near_dup._rare_shingles(ids, sets, 80).count()
        pairs = near_dup._pairs_by_rare_shingles(ids, labels, sets, 80).count()
        rows_made.append(rare + pairs)
    assert rows_made[1] <= 2.2 * rows_made[0]
    result = near_dup.near_copies(docs(spark, framed(40, 14, 4)), 2, listed=0)
    assert sorted(map(tuple, result.collect())) == brute(framed(40, 14, 4), 2)


@pytest.mark.parametrize("seed", range(3))
def test_rare_shingles_meet_every_linked_pair(spark, seed):
    rows = [(i, t) for i, t in chains(seed) if shingles(t, 2)]
    frame = docs(spark, rows)
    sets = near_dup._sets(frame, 2).cache()
    ids = frame.select(frame.doc_id.alias("doc"))
    pairs = near_dup._pairs_by_rare_shingles(ids, ids.selectExpr("doc", "doc AS label"), sets, 80)
    found = {(r.a, r.b) for r in pairs.collect()}
    plain = {i: shingles(t, 2) for i, t in rows}
    linked = {
        (a, b) for a in plain for b in plain if a < b and 100 * len(plain[a] & plain[b]) >= 80 * len(plain[a] | plain[b])
    }
    assert linked and linked <= found


def test_bits_never_claim_too_much(spark):
    """What is surely missing is missing, for short and for very long texts."""
    rng = random.Random(2)
    rows = [(k, " ".join(f"w{rng.randrange(900)}" for _ in range(n))) for k, n in enumerate([3, 40, 300, 9000, 9000])]
    sets = near_dup._sets(docs(spark, rows), 2).select("doc_id", near_dup._bits("shingles").alias("bits"))
    one, other = sets.toDF("a", "x"), sets.toDF("b", "y")
    found = one.crossJoin(other).select("a", "b", near_dup._surely_missing("x", "y").alias("gone")).collect()
    plain = {i: shingles(t, 2) for i, t in rows}
    assert all(r.gone <= len(plain[r.a] - plain[r.b]) for r in found)
    assert any(r.gone > 0 for r in found) and all(r.gone == 0 for r in found if r.a == r.b)
