"""Every query with SQL against DuckDB over the same tables."""

import math
from pathlib import Path

import duckdb
import pytest

from quillmesh.plans import archive, cases, items, tables  # noqa: F401
from quillmesh.plans.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def rows(cols, data):
    order = sorted(range(len(cols)), key=cols.__getitem__)
    plain = lambda v: round(v, 3) if isinstance(v, float) and math.isfinite(v) else v
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    got = QUERIES[name](spark, SF)
    want = con.execute(ORACLES[name])
    cols = [c[0] for c in want.description]
    assert sorted(cols) == sorted(got.columns)
    assert rows(cols, want.fetchall()) == rows(got.columns, [tuple(r) for r in got.collect()])
