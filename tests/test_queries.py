"""Registered queries: DuckDB twins at the smallest scale, and the join strategies of the distance operators."""

import pytest

import atlas.operators.groups
import atlas.operators.localities
import atlas.operators.matching
import atlas.operators.spatial
from atlas.queries import load
from atlas.queries.base import Tables
from atlas.session import cut_lineage
from tests.compare import compare, connect

REGISTRY = load()
FAST = sorted(n for n, q in REGISTRY.items() if q.oracle and n.startswith(("x", "f0", "f1", "t0", "w1", "j2", "j3", "v2", "q0", "s1")) and n not in ("j20_polygon_overlap",)
              and (not n.endswith("_by_name") or n[:3] in ("x02", "x16", "x28")))   # test_sql_functions compares every function
NEED_MORE_ROWS = ("j21_grade_separation", "j22_interchange_exclusion", "t03_bridge_top")   # empty at the smallest scale


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", NEED_MORE_ROWS)
def test_twin_at_a_larger_scale(spark, name):
    larger = "/root/testdata/sf0.01"
    ok, note = compare(spark, connect(larger), larger, name, REGISTRY[name])
    assert ok, note


@pytest.mark.parametrize("name", [n for n in FAST if n not in NEED_MORE_ROWS])
def test_twin(spark, con, folder, name):
    ok, note = compare(spark, con, folder, name, REGISTRY[name])
    assert ok, note


def test_streaming_equals_batch(spark, con, folder):
    ok, note = compare(spark, con, folder, "st1_live_peaks", REGISTRY["st1_live_peaks"])
    assert ok, note


@pytest.mark.parametrize("name", ["j04_by_city", "j06_nearest_locality", "j07_point_in_polygon", "j10_anchor_join", "j12_match_frontiers", "j21_grade_separation"])
def test_no_nested_loops(spark, folder, name, monkeypatch):
    plans = []

    def watched(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut_lineage(df)

    for module in (atlas.operators.groups, atlas.operators.localities, atlas.operators.matching, atlas.operators.spatial):
        monkeypatch.setattr(module, "cut_lineage", watched)
    df = REGISTRY[name].run(spark, folder)
    plans.append(df._jdf.queryExecution().executedPlan().toString())
    for plan in plans:
        assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_scans_read_only_what_is_used(spark, folder):
    plan = Tables(spark, folder).tile_old._jdf.queryExecution().executedPlan().toString()
    assert "o_custkey" not in plan.split("ReadSchema")[-1]


def test_every_query_has_a_stable_schema(spark, folder):
    names = [n for n in FAST if n.startswith("x")]
    for name in names:
        df = REGISTRY[name].run(spark, folder)
        assert len(set(df.columns)) == len(df.columns)
