"""Run registered queries beside their SQL."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(folder: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def rows_of_spark(frame):
    columns = sorted(frame.columns)
    return columns, sorted(map(tuple, frame.select(*columns).collect()), key=repr)


def rows_of_sql(connection, sql: str):
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = [tuple(row[i] for i in order) for row in result.fetchall()]
    return [names[i] for i in order], sorted(rows, key=repr)


# Spark type -> DuckDB type
TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def types_of_spark(frame):
    return {name: TYPES[dtype] for name, dtype in frame.dtypes}


def types_of_sql(connection, sql: str):
    return {row[0]: row[1] for row in connection.execute(f"DESCRIBE {sql}").fetchall()}
