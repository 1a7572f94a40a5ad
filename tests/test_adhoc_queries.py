"""Queries about people who bring their own marks, on events of people with "not seen" marks alone."""

import datetime
import shutil

import duckdb
import pytest
from compare import duck, rows_of_spark, rows_of_sql

from kinrank.plans.registry import ORACLES, QUERIES

SOURCE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def events_with_nobody(tmp_path_factory):
    """The tables of ``SOURCE``, with a person all of whose signup marks are 0."""
    folder = tmp_path_factory.mktemp("nobody")
    shutil.copytree(SOURCE, folder, dirs_exist_ok=True, copy_function=shutil.copyfile)
    folder.chmod(0o755)
    at = datetime.datetime(2024, 1, 5)
    connection = duckdb.connect()
    connection.execute(f"CREATE TABLE e AS SELECT * FROM '{SOURCE}/events.parquet'")
    connection.execute("INSERT INTO e BY NAME SELECT * REPLACE (5000 + event_id AS event_id, 777 AS user_id, 'signup' AS event_type, 3.0 AS value, ?::TIMESTAMP AS ts) FROM e LIMIT 3", [at])
    connection.execute(f"COPY e TO '{folder}/events.parquet' (FORMAT parquet)")
    return str(folder)


def test_people_without_a_mark_get_nothing_and_stop_nobody(spark, events_with_nobody):
    found = rows_of_spark(QUERIES["als_adhoc_described"](spark, events_with_nobody))
    assert found == rows_of_sql(duck(events_with_nobody), ORACLES["als_adhoc_described"])
    people = {r.user_id for r in QUERIES["als_recommend_adhoc"](spark, events_with_nobody).collect()}
    assert len(people) == 15 and -778 not in people
