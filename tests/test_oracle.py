"""Every registered query against its DuckDB SQL on the smallest tables."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from blocklot.plans.catalog import QUERIES
from blocklot.plans.oracle_sql import ORACLE_SQL
from blocklot.sources.tables import DRIVER_TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in DRIVER_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return None
    return v


def _bag(rows, cols):
    return Counter(tuple(_norm(r[c]) for c in cols) for r in rows)


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    out = entry.entry(spark)
    assert out.columns == ["total_rows", "housing_units", "affordable_units"]
    assert out.count() == 1


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF)
    srows = [r.asDict() for r in sdf.collect()]
    cur = con.execute(ORACLE_SQL[name])
    ocols = [d[0] for d in cur.description]
    orows = [dict(zip(ocols, r)) for r in cur.fetchall()]
    assert sorted(sdf.columns) == sorted(ocols)
    cols = sorted(ocols)
    assert len(srows) == len(orows)
    assert _bag(srows, cols) == _bag(orows, cols)
