"""Every registered query of the engine's own operators against its SQL on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from gristmill.plans import oracles, queries

SF = "/root/testdata/sf0.001"
QUERIES, SQL = queries.queries(), oracles.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


def _key(row):
    return tuple("nan" if isinstance(v, float) and math.isnan(v) else repr(v) for v in row)


def test_names():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) - set(SQL) == {"plain_markdown", "flagship_select", "lane_selection", "lane_sweep", "fallback_assignment", "chosen_scenes"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(_key(r[c] for c in columns) for r in df.collect())
    found = duck.execute(SQL[name])
    at = [x[0] for x in found.description]
    assert sorted(at) == columns
    assert got == sorted(_key(r[at.index(c)] for c in columns) for r in found.fetchall())
    assert got
