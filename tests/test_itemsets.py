import math
import random
from itertools import combinations

import pytest

from kinrank.operators import itemsets as i


@pytest.fixture
def baskets(spark):
    return lambda *rows: spark.createDataFrame([(list(r),) for r in rows], "items array<string>")


def as_dict(found):
    return {tuple(r["items"]): r["freq"] for r in found.collect()}


def test_threshold_rounds_up(baskets):
    # 0.3 of 4 is 2
    assert as_dict(i.frequent_itemsets(baskets("ab", "a", "ac", "b"))) == {("a",): 3, ("b",): 2}


def test_repeated_items_count_once(baskets):
    assert as_dict(i.frequent_itemsets(baskets("aab", "ab"), 1.0)) == {
        ("a",): 2,
        ("b",): 2,
        ("a", "b"): 2,
    }


@pytest.mark.parametrize("partitions", [None, 3])
def test_against_all_subsets(baskets, partitions):
    draw = random.Random(2)
    rows = [[x for x in "abcdefg" if draw.random() < 0.5] for _ in range(60)]
    least = math.ceil(0.2 * len(rows))
    expected = {
        items: freq
        for size in range(1, 8)
        for items in combinations("abcdefg", size)
        if (freq := sum(set(items) <= set(row) for row in rows)) >= least
    }
    assert as_dict(i.frequent_itemsets(baskets(*rows), 0.2, partitions)) == expected


def test_text_and_counts(baskets):
    found = i.frequent_itemsets(baskets("ab", "ab"), 0.5)
    assert {r["text"] for r in i.itemset_text(found).collect()} == {"[a], 2", "[b], 2", "[a,b], 2"}
    assert i.itemset_count(found).first()["n_itemsets"] == 3
    assert i.transaction_count(baskets("ab", "")).first()["n_transactions"] == 2


def test_cache_is_released(spark, baskets):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    i.frequent_itemsets(baskets("ab", "ab")).collect()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
