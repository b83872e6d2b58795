"""Every registered query against its DuckDB SQL on the smallest fixture, plus the driver contract."""

import pytest

import __spark_entry__ as entry
from cardwatch.plans import catalog, oracle
from conftest import SF0001
from tools.check_oracle import duck, rows

ORACLE = oracle.oracle_sql()
BATCH = [n for n in catalog.QUERIES if not n.startswith("stream_")]
STREAM = [n for n in catalog.QUERIES if n.startswith("stream_")]


@pytest.fixture(scope="module")
def con():
    return duck(SF0001)


def test_every_query_has_an_oracle_or_a_reason():
    missing = set(catalog.QUERIES) - set(ORACLE)
    assert not missing, missing
    assert set(ORACLE) <= set(catalog.QUERIES)
    assert set(catalog.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_contract(spark):
    df = entry.entry(spark)
    assert df.columns == ["final_rule", "alert_count"]
    assert df.count() >= 0


def _check(spark, con, name):
    s = entry.queries()[name](spark, SF0001).toPandas()
    d = con.execute(ORACLE[name]).df()
    assert sorted(s.columns) == sorted(d.columns)
    assert len(s) == len(d)
    assert rows(s) == rows(d)


@pytest.mark.parametrize("name", BATCH)
def test_batch_query_matches_duckdb(spark, con, name):
    _check(spark, con, name)


@pytest.mark.parametrize("name", [n for n in STREAM if n in ORACLE])
def test_stream_query_matches_duckdb(spark, con, name):
    _check(spark, con, name)
