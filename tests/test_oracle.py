"""Every registered query with an oracle matches DuckDB on sf0.001 (the driver uses sf0.01)."""

import os
import sys

import duckdb
import pytest

from conftest import ROOT, SF001

sys.path.insert(0, os.path.join(ROOT, "tools"))
import __spark_entry__ as E  # noqa: E402
from check_oracle import TABLES, digest  # noqa: E402

NAMES = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    s = digest(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(E.oracle_sql()[name])
    d = digest([x[0] for x in res.description], res.fetchall())
    assert s[:3] == d[:3]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "TERMINAL_ID_RISK_30DAY_WINDOW" in df.columns
