"""Physical plans: what is shuffled, broadcast, pruned and pushed down."""

import re

import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plans(spark):
    held = {}

    def get(name):
        if name not in held:
            held[name] = entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        return held[name]

    return get


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_no_cross_join_and_no_row_at_a_time_python(plans, name):
    text = plans(name)
    for bad in ("CartesianProduct", "NestedLoopJoin", "BatchEvalPython", "MapInPandas", "ArrowEvalPython", "CollectLimit", "GlobalLimit"):
        assert bad not in text


@pytest.mark.parametrize(
    ("name", "count"),
    [("et_penman_monteith", 3), ("overlay_3way", 3), ("overlay_outer", 2), ("rasterize", 1), ("raster_load", 0),
     ("reshape_nn", 0), ("svp_slope", 0), ("raster_minmax", 1), ("cluster_cells", 1),
     ("range_query", 0), ("range_query_count", 1), ("pip_intersects", 0), ("geotag_points", 0), ("granule_select", 0),
     ("road_segments", 0), ("polygon_centroid", 0), ("feature_summary", 1), ("flatten", 1), ("tile_count", 3)],
)
def test_number_of_shuffles(plans, name, count):
    assert len(re.findall(r"(?<!Broadcast)Exchange ", plans(name))) == count


def test_overlay_never_broadcasts(plans):
    for name in ("et_penman_monteith", "overlay_3way", "overlay_tiles", "fao56_et0", "tile_algebra"):
        assert "BroadcastHashJoin" not in plans(name) and "SortMergeJoin" in plans(name)


def test_only_needed_columns_are_read(plans):
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plans("et_penman_monteith"))
    assert sorted(schemas) == [
        "event_id:bigint,value:double",
        "l_orderkey:bigint,l_quantity:double,l_discount:double,l_tax:double",
        "o_orderkey:bigint,o_custkey:bigint",
    ]


def test_filters_reach_the_scan(plans):
    text = plans("range_pushdown")
    for pushed in ("GreaterThanOrEqual(l_extendedprice,20000.0)", "LessThanOrEqual(l_quantity,30.0)"):
        assert pushed in text
    assert "EqualTo((l_linenumber - 1),0)" in plans("band_select") or "l_linenumber" in re.search(
        r"DataFilters: \[[^\]]*\]", plans("band_select")).group(0)


def test_scalars_are_subqueries(plans):
    assert "Subquery" in plans("fao56_et0")
