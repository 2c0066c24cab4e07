"""Every registered query against its DuckDB oracle on the smallest scale."""
import duckdb
import pytest

import __spark_entry__ as E
from castline.plans.registry import load
from castline.sources.bindings import BASE_TABLES
from tests.conftest import SF_SMALL
from tests.test_plans import FORBIDDEN
from tools.check_oracle import rows_of

QUERIES = {n: q for n, q in E.queries().items() if n in load()}
ORACLE = {n: q for n, q in E.oracle_sql().items() if n in load()}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in BASE_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert len(QUERIES) >= 120


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for op in FORBIDDEN:   # no all-pairs joins, no Python UDF operators
        assert op not in plan, f"{name}: {op}"
    cur = con.execute(ORACLE[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(dcols, cur.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "metric_date"
