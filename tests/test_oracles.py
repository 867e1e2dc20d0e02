"""Every registered query against its DuckDB oracle on the smoke tables
(the same comparison the correctness gate makes at sf0.01)."""
import math

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ["documents", "pages", "conversations", "benchmark", "labels", "events"]
ORACLES = E.oracle_sql()


def norm(v):
    if isinstance(v, float):
        return round(v, 9) if not math.isnan(v) else "nan"
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return norm(v.asDict())
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "accuracy_pct" in df.columns


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(repr(tuple(norm(r[c]) for c in cols)) for r in df.collect())
    if name not in ORACLES:
        pytest.skip("no SQL oracle (rows-only check)")
    rel = con.sql(ORACLES[name])
    ocols = list(rel.columns)
    assert sorted(ocols) == cols
    idx = sorted(range(len(ocols)), key=lambda i: ocols[i])
    want = sorted(repr(tuple(norm(r[i]) for i in idx)) for r in rel.fetchall())
    assert got == want
