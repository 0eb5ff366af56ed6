"""Runs queries against their DuckDB twins."""

from __future__ import annotations

import glob
import math
import os

import duckdb

DATA = "/root/testdata"


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(connection, found, sql: str) -> tuple[list[tuple], list[tuple], int]:
    """Rows only in the DataFrame, rows only in the SQL result, rows of the DataFrame."""
    expected = connection.execute(sql)
    names = [d[0] for d in expected.description]
    assert sorted(names) == sorted(found.columns), (sorted(names), sorted(found.columns))
    ours = rows_of(found.columns, [tuple(row) for row in found.collect()])
    theirs = rows_of(names, expected.fetchall())
    if ours == theirs:
        return [], [], len(ours)
    only_ours, only_theirs = list(ours), list(theirs)
    for row in ours:
        if row in set(theirs):
            only_ours.remove(row)
    for row in theirs:
        if row in set(ours):
            only_theirs.remove(row)
    return only_ours or ours[:3], only_theirs or theirs[:3], len(ours)
