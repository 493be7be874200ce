"""Every registered query of the library against its SQL equivalent, on the smallest given tables."""

import glob
import os

import duckdb
import pytest

from checks.oracle import ORACLES
from checks.queries import QUERIES

TABLES = "/root/testdata/sf0.001"


def told(value):
    return f"{value:.9g}" if isinstance(value, float) else str(value)


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in glob.glob(f"{TABLES}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, database, name):
    frame = QUERIES[name](spark, TABLES)
    columns = sorted(frame.columns)
    got = sorted(tuple(map(told, row)) for row in frame.select(columns).collect())
    if name in ORACLES:
        result = database.execute(ORACLES[name])
        names = [column[0] for column in result.description]
        order = sorted(range(len(names)), key=names.__getitem__)
        assert columns == sorted(names)
        assert got == sorted(tuple(told(row[i]) for i in order) for row in result.fetchall())
