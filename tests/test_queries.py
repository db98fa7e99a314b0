"""Every registered query on the smallest driver tables, against its SQL."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from marquee.bindings.queries import QUERIES as LISTING_QUERIES
from tools.check import TABLES, rows_of

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="driver tables are not here")
# The corpus queries have tests of their own.
QUERIES = {name: made for name, made in entry.queries().items() if name in LISTING_QUERIES}
ORACLES = {name: sql for name, sql in entry.oracle_sql().items() if name not in entry.CORPUS_QUERIES}


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def test_every_sql_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, db, name):
    df = QUERIES[name](spark, str(FOLDER))
    result = db.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, result.fetchall())
