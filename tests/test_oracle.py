"""Every registered query against its DuckDB statement on the smallest driver scale."""

import duckdb
import pytest

import __spark_entry__ as entry_module
from conftest import SF_SMALL
from qalens.plans import registry
from tools.oracle_check import TABLES, digest

@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return con


def test_every_query_has_an_oracle():
    assert set(registry.queries()) == set(registry.oracle_sql())


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = entry_module.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck.sql(entry_module.oracle_sql()[name])
    expected = res.fetchall()
    assert sorted(df.columns) == sorted(res.columns)
    assert len(rows) == len(expected)
    assert digest(df.columns, rows) == digest(res.columns, expected)


def test_entry_smoke(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["tag", "mean_minutes", "probability"]
    assert df.count() > 0
