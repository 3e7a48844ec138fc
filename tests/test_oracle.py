"""Every registered query against its DuckDB oracle on sf0.001 (the driver does the same
at sf0.01). Queries without an oracle must at least run."""

from __future__ import annotations

import os

import duckdb
import pytest
from conftest import ROOT, SF_SMALL

import __spark_entry__ as E

from tools.oracle_check import TABLES, _digest  # noqa: E402

from marketlake.plans.queries import QUERIES as OWN  # noqa: E402

QUERIES = {name: fn for name, fn in E.queries().items() if name in OWN}
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) - set(ORACLES) == set()
    assert ROOT


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    scols, srows = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLES[name])
    dcols, drows = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _digest(scols, srows)[0] == _digest(dcols, drows)[0]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert len(df.columns) == 77 and df.count() >= 0
