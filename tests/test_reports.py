"""Every query with SQL gives the SQL's rows on small tables."""

from __future__ import annotations

import math
import os
from decimal import Decimal

import duckdb
import pytest

from newslens.plans.registry import ORACLE_SQL, QUERIES
from newslens.plans.views import TABLES

SF_DIR = "/root/testdata/sf0.001"


def _plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, (int, float, Decimal)) and not isinstance(value, bool):
        return float(value)
    return str(value)


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables")
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    rows = [tuple(_plain(r[c]) for c in sorted(frame.columns)) for r in frame.collect()]
    if name not in ORACLE_SQL:
        assert rows
        return
    found = duck.execute(ORACLE_SQL[name])
    columns = [x[0] for x in found.description]
    assert sorted(columns) == sorted(frame.columns)
    order = [columns.index(c) for c in sorted(columns)]
    want = [tuple(_plain(r[k]) for k in order) for r in found.fetchall()]
    assert sorted(rows, key=str) == sorted(want, key=str)
