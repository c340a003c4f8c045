"""Every registered query against DuckDB on the same tables."""

import os
from decimal import Decimal
import math

import duckdb
import pytest

from tallyframe.plans.registered import ORACLES, QUERIES

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def cell(value):
    if isinstance(value, Decimal):
        return int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    return value


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(cell(row[i]) for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_duckdb(spark, duck, capsys, name):
    result = QUERIES[name](spark, FOLDER)
    result.explain()
    plan = capsys.readouterr().out
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Python" not in plan
    rows = result.collect()
    sql = ORACLES.get(name)
    assert sql is not None, "every query has its SQL"
    expected = duck.sql(sql)
    assert sorted(result.columns) == sorted(expected.columns)
    found, wanted = as_rows(result.columns, rows), as_rows(expected.columns, expected.fetchall())
    assert len(found) == len(wanted)
    assert found == wanted
    assert found, "a check on no rows proves nothing"
