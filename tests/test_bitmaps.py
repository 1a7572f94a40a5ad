"""Mergeable counts of distinct users and products."""

import random

from pyspark.sql import functions as F

from kinrank.operators import quality as q

SCHEMA = "user_id bigint, product_id int, part string"


def sample(n=2000):
    draw = random.Random(3)
    ids = [0, 1, -1, 63, 64, -64, -65, 2**62, -(2**62), 2**63 - 1, -(2**63)]
    return [
        (draw.choice([*ids, draw.randint(-500, 500), None]), draw.choice([draw.randint(-5, 300), None]), draw.choice("abc"))
        for _ in range(n)
    ]


def expected(rows):
    return (len(rows), len({u for u, _, _ in rows} - {None}), len({p for _, p, _ in rows} - {None}))


def test_counts_of_parts_and_of_all(spark):
    rows = sample()
    got = q.split_summaries(spark.createDataFrame(rows, SCHEMA), "part").collect()
    want = {part: expected([r for r in rows if r[2] == part]) for part in "abc"} | {None: expected(rows)}
    assert {r.part: (r.n_ratings, r.n_users, r.n_products) for r in got} == want


def test_bitmaps_of_days_merge(spark):
    rows = sample()
    days = [q.id_bitmaps(spark.createDataFrame(rows[low : low + 500], SCHEMA)) for low in range(0, 2000, 500)]
    union = days[0]
    for day in days[1:]:
        union = union.unionByName(day)
    got = q.bitmap_summary(q.merged_bitmaps(union)).collect()
    assert [tuple(r) for r in got] == [expected(rows)]


def test_one_pass_and_hash_aggregation(spark):
    frame = spark.createDataFrame(sample(50), SCHEMA)
    plan = q.ratings_summary(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "SortAggregate" not in plan


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert [tuple(r) for r in q.ratings_summary(empty).collect()] == [(0, 0, 0)]
    assert [tuple(r) for r in q.split_summaries(empty, "part").collect()] == [(None, 0, 0, 0)]
    assert q.bitmap_summary(q.id_bitmaps(empty.where(F.lit(True)), ("part",)), ("part",)).collect() == []
