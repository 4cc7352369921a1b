import os
import re

import duckdb
import pytest

import __spark_entry__ as entry
from sf_dirs import SF_SMALL

ORACLE_NAMES = sorted(entry.oracle_sql())


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 5
    assert df.columns == ["cluster", "number_of_points", "centroid_x", "centroid_y", "dispersion"]


def test_every_query_has_an_oracle_or_is_rows_only():
    q, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(q)
    # Operators on text that learn, search or tokenise have brute-force tests instead.
    assert {n for n in set(q) - set(sql) if n != "pipeline" and not re.match(r"op\d+_", n)} == set()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF_SMALL):
        if f.endswith(".parquet"):
            con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{SF_SMALL}/{f}')")
    return con


@pytest.mark.parametrize("name", ORACLE_NAMES)
def test_query_matches_oracle(spark, duck, name):
    sdf = entry.queries()[name](spark, SF_SMALL)
    res = duck.execute(entry.oracle_sql()[name])
    cols = [c[0] for c in res.description]
    assert sdf.columns == cols
    got = sorted(map(tuple, sdf.collect()), key=repr)
    want = sorted(res.fetchall(), key=repr)
    assert got == want


def test_positive_zero_rounding():
    from orbitfit.plans import positive_zero_rounding as f
    assert f("SELECT round(a, 6) AS a, xround(b), round(round(c, 2), 1) FROM t") == (
        "SELECT (round(a, 6) + 0.0) AS a, xround(b), (round((round(c, 2) + 0.0), 1) + 0.0) FROM t")
    import duckdb
    raw = duckdb.connect().execute("SELECT round(CAST('-0.0000001' AS DOUBLE), 6)").fetchone()[0]
    fixed = duckdb.connect().execute(f("SELECT round(CAST('-0.0000001' AS DOUBLE), 6)")).fetchone()[0]
    assert str(raw) == "-0.0" and str(fixed) == "0.0"
