import pytest
from pyspark.errors import PySparkException

from kinrank.operators.quality import InvalidRatingsError
from kinrank.sources.provider import load_colon_separated, load_tab_separated
from kinrank.sources.text import (
    COLONS,
    PIPE,
    TAB,
    parse_names,
    parse_ratings,
    parse_transactions,
    read_names,
    read_transactions,
)


@pytest.fixture
def lines(spark):
    return lambda *values: spark.createDataFrame([(v,) for v in values], "value string")


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield
    spark.conf.set("spark.sql.ansi.enabled", before)


def tuples(frame):
    return [tuple(row) for row in frame.collect()]


def test_fields_beyond_the_rating_are_ignored(lines, ansi):
    rows = tuples(parse_ratings(lines("7\t3\t4.5\t1700000000\textra", "1\t2\t0"), TAB))
    assert rows == [(7, 3, 4.5), (1, 2, 0.0)]


def test_timestamp_digit_and_shift(lines):
    parsed = parse_ratings(lines("1::2::5::1700000009"), COLONS, keep_ts=True, implicit=True)
    assert tuples(parsed) == [(1, 2, 2.5, 1700000009, 9)]


@pytest.mark.parametrize("line", ["1::2", "1::x::3", "", "::2::3", "1.5::2::3"])
def test_malformed_ratings_fail(lines, ansi, line):
    with pytest.raises(PySparkException, match="malformed|CAST_INVALID_INPUT"):
        parse_ratings(lines("1::2::3", line), COLONS).collect()


def test_short_line_for_timestamp_fails(lines, ansi):
    with pytest.raises(PySparkException):
        parse_ratings(lines("1::2::3"), COLONS, keep_ts=True).collect()


def test_names(lines, ansi):
    assert tuples(parse_names(lines("1|A name (1)|b||x"), PIPE)) == [(1, "A name (1)")]
    assert tuples(parse_names(lines("9::A | B::x|y"), COLONS)) == [(9, "A | B")]
    with pytest.raises(PySparkException):
        parse_names(lines("9"), COLONS).collect()


def test_last_name_wins(spark):
    rows = [("1::old", 1), ("1::new", 3), ("1::middle", 2), ("2::only", 0)]
    frame = spark.createDataFrame(rows, "value string, line int")
    assert sorted(tuples(parse_names(frame, COLONS, "line"))) == [(1, "new"), (2, "only")]


def test_last_name_of_a_file_wins(spark, tmp_path):
    path = tmp_path / "names"
    path.write_text("".join(f"{i % 50}|name {i}|x\n" for i in range(1000)))
    assert sorted(tuples(read_names(spark, str(path), PIPE))) == [
        (i, f"name {950 + i}") for i in range(50)
    ]


def test_transactions(lines):
    found = parse_transactions(lines("a b c", "a b  ", "a  b", " a", "", "   "))
    assert [row["items"] for row in found.collect()] == [
        ["a", "b", "c"],
        ["a", "b"],
        ["a", "", "b"],
        ["", "a"],
        [""],
        [],
    ]


def test_read_transactions(spark, tmp_path):
    (tmp_path / "t").write_text("a b\na\n")
    assert sorted(r["items"] for r in read_transactions(spark, str(tmp_path)).collect()) == [
        ["a"],
        ["a", "b"],
    ]


def test_providers_check_what_they_load(spark, tmp_path):
    ratings, names = tmp_path / "r", tmp_path / "n"
    ratings.write_text("1\t10\t5\t7\n2\t20\t0\t8\n")
    names.write_text("10|ten|x\n20|twenty|y\n")
    data = load_tab_separated(spark, str(ratings), str(names))
    assert sorted(tuples(data.ratings)) == [(1, 10, 5.0), (2, 20, 0.0)]
    assert sorted(tuples(data.names)) == [(10, "ten"), (20, "twenty")]

    ratings.write_text("1::10::6::7\n")
    names.write_text("10::ten::x\n")
    with pytest.raises(InvalidRatingsError):
        load_colon_separated(spark, str(ratings), str(names))
