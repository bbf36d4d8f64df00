"""Every registered query against its DuckDB oracle on the small tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from tabflow.queries import all_queries, oracle_sqls
from tabflow.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
SQLS = oracle_sqls()
QUERIES = all_queries()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    yield con
    con.close()


def _key(row):
    return tuple((0, "") if v is None else (1, v if isinstance(v, (int, float)) else str(v)) for v in row)


def _same(a, b):
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, float) or isinstance(b, float):
        return math.isclose(float(a), float(b), rel_tol=1e-9, abs_tol=1e-9)
    return a == b


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 10 and "revenue" in df.columns


def test_every_query_has_oracle_or_is_rows_only():
    rows_only = set(QUERIES) - set(SQLS)
    assert rows_only <= {"format_report", "sample_seeded", "ml_linreg_metrics", "ml_als_topn", "profile_summary"}


@pytest.mark.parametrize("name", sorted(SQLS))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF)
    cols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(SQLS[name])
    dcols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(dcols)
    idx = [dcols.index(c) for c in cols]
    drows = [tuple(r[i] for i in idx) for r in res.fetchall()]
    assert len(srows) == len(drows)
    for x, y in zip(sorted(srows, key=_key), sorted(drows, key=_key)):
        assert all(_same(a, b) for a, b in zip(x, y)), (x, y)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQLS)))
def test_rows_only_queries_run(spark, name):
    assert QUERIES[name](spark, SF).count() >= 0
