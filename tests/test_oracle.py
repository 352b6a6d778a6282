"""Every registered query equals its DuckDB oracle on the smallest fixture."""

import os
import re

import duckdb
import pytest

from conftest import SF0001

import __spark_entry__ as entry
from scripts.check_oracle import TABLES, digest
from tidewater.registry import ORACLE, QUERIES

KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF0001}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_unpartitioned_window_detector():
    assert _unpartitioned_windows("+- Window [sum(x#1) windowspecdefinition(specifiedwindowframe(RowFrame))) AS s#2]")
    assert not _unpartitioned_windows(
        "+- Window [sum(x#1) windowspecdefinition(k#1, specifiedwindowframe(RowFrame)) AS s#4], [k#1], [id#0 ASC]")


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


# Plan shapes that do not survive 100 TB: all pairs, or everything in one task.
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin")


def _unpartitioned_windows(plan: str) -> list:
    """Window operators without a partition spec (they run in one task)."""
    out = []
    for ln in plan.splitlines():
        body = ln.lstrip(" :+-")
        if body.startswith("Window ["):
            m = re.search(r"\], \[([^\[\]]*)\], \[[^\]]*\]$", body)
            if m is None or not m.group(1).strip():
                out.append(body)
    return out


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF0001)
    qe = df._jdf.queryExecution()
    assert not [f for f in FORBIDDEN if f in qe.executedPlan().toString()], key
    assert not _unpartitioned_windows(qe.optimizedPlan().toString()), key
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(entry.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 119
