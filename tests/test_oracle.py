"""Every registered query against its DuckDB oracle on the sf0.01 tables."""

import math
import os

import duckdb
import pytest

from gapscope.plans.oracle import ORACLE
from gapscope.plans.queries import QUERIES

SF = "/root/testdata/sf0.01"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = []
    for r in rows:
        vals = []
        for i in order:
            v = r[i]
            if isinstance(v, float) and math.isnan(v):
                v = "nan"
            vals.append((v is not None, repr(v) if v is not None else ""))
        out.append(tuple(vals))
    return sorted(out), [cols[i] for i in order]


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables missing")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    s, sc = _norm([tuple(r) for r in df.collect()], df.columns)
    res = con.execute(ORACLE[name])
    d, dc = _norm(res.fetchall(), [x[0] for x in res.description])
    assert sc == dc
    assert len(s) == len(d)
    assert s == d


def test_entry_smoke(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.columns[:2] == ["jurisdiction", "year"] and "gap_statutory_minus_effective" in df.columns
    assert df.count() > 0
