"""Every registered query of the core against its independent SQL statement."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entrypoint
from kpiloom.plans import catalog
from oracle import statements
from tests.conftest import SF_DIR

QUERIES = catalog.registered()
STATEMENTS = statements()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return repr(round(float(value), 6))
    return str(value)


def multiset(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(STATEMENTS)
    assert set(QUERIES) <= set(entrypoint.queries())
    assert set(STATEMENTS) <= set(entrypoint.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_statement(spark, db, name):
    ours = QUERIES[name](spark, SF_DIR)
    theirs = db.execute(STATEMENTS[name])
    names = [d[0] for d in theirs.description]
    assert sorted(ours.columns) == sorted(names)
    assert multiset(ours.columns, ours.collect()) == multiset(names, theirs.fetchall())


def test_entry(spark):
    assert entrypoint.entry(spark).count() == 80
