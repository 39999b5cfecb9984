"""Every driver query against its DuckDB oracle at sf0.001 (the driver does this at sf0.01)."""

import hashlib
import math
import os

import duckdb
import pytest

import __spark_entry__ as E

SF = os.environ.get("GRIDLAKE_TEST_SF", "/root/testdata/sf0.001")
KEYS = sorted(E.QUERIES)


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted(hashlib.md5("|".join(str(_norm(r[i])) for i in order).encode()).hexdigest()
                   for r in rows)
    return [cols[i] for i in order], len(rows), hashlib.md5("".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("events",):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(KEYS) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["device_name", "n", "power_milli", "avg_power"]
    assert df.count() > 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF)
    got = _digest(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(E.oracle_sql()[key])
    want = _digest([d[0] for d in res.description], res.fetchall())
    assert got == want
