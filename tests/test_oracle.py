"""Every registered query equals its DuckDB oracle on the smallest driver tables."""

import os

import duckdb
import re

import pytest

import __spark_entry__ as E
from strata.plans.catalog import ALL_TABLES
from tools.compare import _digest

# STRATA_ORACLE_SF=/root/testdata/sf0.01 runs the same check on the driver's correctness scale
SF = os.environ.get("STRATA_ORACLE_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ALL_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows)[0] == _digest(ocols, orows)[0]


def test_every_query_has_an_oracle_or_a_reason():
    assert {k for k in set(E.queries()) - set(E.oracle_sql()) if not re.match(r"op\d+_|pipeline$", k)} == set()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "latest_market_value" in df.columns


def test_readme_lists_every_query_key():
    import os
    readme = open(os.path.join(os.path.dirname(os.path.dirname(__file__)), "README.md")).read()
    missing = [k for k in E.queries() if k not in readme]
    assert not missing, missing
