import pytest

from kinrank.operators import quality as q


def tuples(frame):
    return sorted(tuple(row) for row in frame.collect())


@pytest.fixture
def names(spark):
    return spark.createDataFrame([(1, "one"), (2, "two")], "product_id bigint, name string")


def test_bounds_are_valid(frame, names):
    rows = [(1, 1, -1.0), (1, 1, 0.0), (1, 2, 5.0), (1, 2, 5.5), (1, 3, 3.0), (1, 3, 9.0)]
    assert tuples(q.invalid_ratings(frame(rows), names)) == [
        (1, 1, -1.0, "below range"),
        (1, 2, 5.5, "above range"),
        (1, 3, 3.0, "unknown product"),
        (1, 3, 9.0, "above range"),
    ]


def test_repeated_names_repeat_no_rows(frame, names):
    assert q.invalid_ratings(frame([(1, 1, 9.0)]), names.union(names)).count() == 1


def test_require_valid(frame, names):
    good = frame([(1, 1, 5.0)])
    assert q.require_valid(good, names) is good
    with pytest.raises(q.InvalidRatingsError):
        q.require_valid(frame([(1, 3, 5.0)]), names)


def test_adhoc(frame):
    rows = [(-1, 1, 5.0), (-1, 2, 4.0), (-1, 3, 3.0), (-1, 4, 0.0), (-1, 5, 2.0)]
    nothing = [(-2, 1, 0.0), (-2, 2, 0.0)]
    assert len(tuples(q.require_adhoc(frame(rows)))) == 4
    assert tuples(q.adhoc_users_without_ratings(frame(rows + nothing))) == [(-2,)]
    with pytest.raises(q.NoRatingsError):
        q.require_adhoc(frame(rows + nothing))


def test_union_keeps_duplicates(frame):
    rows = frame([(1, 1, 5.0)])
    assert q.with_adhoc(rows, rows).count() == 2


def test_unknown_users(spark, frame):
    ratings = frame([(1, 1, 5.0), (1, 2, 5.0)])
    targets = spark.createDataFrame([(1,), (1,), (9,)], "user_id bigint")
    assert tuples(q.unknown_users(targets, ratings)) == [(9,)]
    assert tuples(q.known_targets(targets, ratings, "drop")) == [(1,)]
    with pytest.raises(q.UnknownUserError):
        q.known_targets(targets, ratings)
    with pytest.raises(ValueError):
        q.known_targets(targets, ratings, "ignore")


def test_users_below(frame):
    rows = [(1, p, 1.0) for p in range(20)] + [(2, p, 1.0) for p in range(19)]
    assert tuples(q.users_below(frame(rows))) == [(2, 19)]


def test_summary(frame):
    assert tuples(q.ratings_summary(frame([(1, 1, 1.0), (1, 2, 1.0), (2, 2, 1.0)]))) == [(3, 2, 2)]
    assert tuples(q.ratings_summary(frame([]))) == [(0, 0, 0)]


def test_histories_are_bounded_and_whole(frame):
    rows = [(1, p, float(p % 6)) for p in range(5000)] + [(2, 7, 3.0)]
    found = q.user_histories(frame(rows), span=1000).orderBy("user_id", "chunk").collect()
    assert [r["n_ratings"] for r in found] == [1000] * 5 + [1]
    whole = [tuple(entry) for r in found[:5] for entry in r["history"]]
    assert whole == [(p, float(p % 6)) for p in range(5000)]


def test_histories_of_targets(spark, frame):
    targets = spark.createDataFrame([(2,)], "user_id bigint")
    found = q.user_histories(frame([(1, 1, 1.0), (2, 1, 1.0)]), targets).collect()
    assert [r["user_id"] for r in found] == [2]


@pytest.mark.parametrize("mark", [6.0, -3.0, float("nan"), None])
def test_an_impossible_mark_is_refused(frame, mark):
    marks = frame([(-1, 1, mark), (-1, 2, 4.0)])
    with pytest.raises(q.InvalidRatingsError):
        q.require_adhoc(marks)
    with pytest.raises(Exception, match="outside 0 to 5"):
        q.clean_adhoc(marks).collect()
    assert q.impossible_marks(marks).count() == 1


def test_marks_below_one_are_kept_and_zeros_dropped(frame):
    marks = frame([(-1, 1, 0.5), (-1, 2, 0.0), (-1, 3, 4.0)])
    assert sorted(r["rating"] for r in q.require_adhoc(marks).collect()) == [0.5, 4.0]


def test_a_null_rating_is_invalid(spark, frame):
    names = spark.createDataFrame([(1, "a")], "product_id bigint, name string")
    assert [r["reason"] for r in q.invalid_ratings(frame([(1, 1, None)]), names).collect()] == ["no rating"]


def test_chunks_of_large_and_negative_ids(frame):
    rows = [(1, 2**53 + 1, 1.0), (1, 2**40, 2.0), (1, -1, 3.0)]
    found = {r["chunk"] for r in q.user_histories(frame(rows), span=1000).collect()}
    assert found == {(2**53 + 1) // 1000, 2**40 // 1000, -1}
