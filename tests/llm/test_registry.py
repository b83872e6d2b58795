"""The registered text queries: names, SQL where there is one, and the driver's entry."""

import pytest

import __spark_entry__ as entry
from cardwatch.llm import registry
from tools.check_oracle import duck, rows

SF = "/root/testdata/sf0.001"


def test_all_operators_and_the_pipeline_are_registered():
    names = sorted(registry.QUERIES, key=lambda n: int(n[2:].split("_")[0]))
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert set(names) | {"pipeline"} <= set(entry.queries())
    assert set(registry.ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(registry.ORACLE_SQL))
def test_query_matches_duckdb(spark, name):
    got = registry.QUERIES[name](spark, SF).toPandas()
    want = duck(SF).execute(registry.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)
