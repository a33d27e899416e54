"""Every registered query of the engine against its SQL in DuckDB."""

from __future__ import annotations

import datetime
import math
import os

import pytest

duckdb = pytest.importorskip("duckdb")

from voxelloom.plans.catalog import ORACLES, QUERIES  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for name in sorted(os.listdir(SF)):
        c.sql(f"create view {name.split('.')[0]} as select * from '{SF}/{name}'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5)
    return v.replace(tzinfo=None) if isinstance(v, datetime.datetime) else v


def rows(names, data):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted((tuple(plain(r[k]) for k in order) for r in data), key=str)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    got = df.collect()
    if name not in ORACLES:
        assert got
        return
    want = con.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert rows(df.columns, got) == rows(want.columns, want.fetchall())


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_mask_labels_match_brute_force(spark):
    from voxelloom.plans.volume_queries import voxels

    cells = {(r.z, r.y, r.x) for r in voxels(spark, SF).filter("v > 49").select("z", "y", "x").distinct().collect()}
    want, todo = {}, []
    for start in sorted(cells):
        if start not in want:
            want[start], todo = (start[0] * 64 + start[1]) * (1 << 31) + start[2], [start]
        while todo:
            z, y, x = todo.pop()
            for near in ((z, y + 1, x), (z, y - 1, x), (z, y, x + 1), (z, y, x - 1)):
                if near in cells and near not in want:
                    want[near] = want[z, y, x]
                    todo.append(near)
    got = QUERIES["mask_component_labels"](spark, SF).collect()
    assert len(got) == len(cells) and {(r.z, r.y, r.x): r.label for r in got} == want
