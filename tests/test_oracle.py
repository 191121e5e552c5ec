"""Every registered query against its SQL, on the test tables."""

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for f in sorted(Path(SF_DIR).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return connection


def test_every_query_of_the_library_has_its_sql():
    assert set(QUERIES) - set(contract.CORPUS_QUERIES) <= set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(ORACLES) - set(contract.CORPUS_SQL)))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    cols = sorted(df.columns)
    result = duck.execute(ORACLES[name])
    named = [d[0] for d in result.description]
    expected = [dict(zip(named, r)) for r in result.fetchall()]
    assert sorted(named) == cols
    key = lambda r: tuple((v is not None, str(v)) for v in r)
    got = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=key)
    assert got == sorted((tuple(r[c] for c in cols) for r in expected), key=key)
    assert got


def test_entry(spark):
    assert contract.entry(spark).limit(1).count() == 1
