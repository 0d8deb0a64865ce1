"""Every registered query of the library's own jobs against its DuckDB oracle on
sf0.001 (rows, columns, order-insensitive values); no plan builds all pairs."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from adspend.testkit import registry
from tools.check import digest

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "orders", "lineitem", "events"]
QUERIES, ORACLE = registry.QUERIES, registry.ORACLE


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE) and set(QUERIES) <= set(E.queries())


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLE[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(rows, df.columns) == digest(orows, ocols)


def test_entry_runs(spark):
    assert E.entry(spark).count() > 0
