"""Exact tests between lines and polygons."""

import pytest
from pyspark.sql import functions as F

from terraframe.functions import geometry as G
from terraframe.operators import spatial_join as sj
from terraframe.operators import vector

RINGS, PATH = sj.RINGS, sj.PATH


def ring(*corners):
    return [{"x": float(x), "y": float(y)} for x, y in [*corners, corners[0]]]


def square(x, y, size):
    return ring((x, y), (x + size, y), (x + size, y + size), (x, y + size))


HOLED = [square(0, 0, 10), square(4, 4, 2)[::-1]]
NOTCHED = [ring((0, 0), (10, 0), (10, 10), (5, 2), (0, 10))]
# Name, polygon, shape, meets, lies within.
AREAS = [
    ("inside", HOLED, [square(1, 1, 2)], True, True),
    ("same", HOLED, HOLED, True, True),
    ("touches border from inside", HOLED, [square(0, 0, 3)], True, True),
    ("touches border from outside", HOLED, [square(10, 0, 3)], True, False),
    ("touches a corner", HOLED, [square(10, 10, 3)], True, False),
    ("apart", HOLED, [square(11, 0, 3)], False, False),
    ("crosses", HOLED, [square(8, 8, 5)], True, False),
    ("within the hole", HOLED, [square(4.5, 4.5, 1)], False, False),
    ("fills the hole", HOLED, [square(4, 4, 2)], True, False),
    ("around the hole", HOLED, [square(3, 3, 4)], True, False),
    ("around with the hole", HOLED, [square(3, 3, 4), square(4, 4, 2)[::-1]], True, True),
    ("around all", HOLED, [square(-5, -5, 30)], True, False),
    ("hole with its corners on the border", [square(0, 0, 10), ring((0, 5), (5, 10), (10, 5), (5, 0))], [square(0, 0, 10)], True, False),
    ("over the notch", NOTCHED, [ring((0, 0), (10, 0), (10, 10), (0, 10))], True, False),
    ("two parts, one inside", HOLED, [square(20, 20, 1), square(1, 1, 1)], True, False),
]
LINES = [
    ("inside", HOLED, [(1, 1), (2, 3)], True, True),
    ("on the border only", HOLED, [(0, 0), (10, 0)], True, False),
    ("border, then inside", HOLED, [(0, 0), (3, 0), (3, 3)], True, True),
    ("through the hole", HOLED, [(1, 5), (9, 5)], True, False),
    ("corner to corner across a notch", NOTCHED, [(0, 10), (10, 10)], True, False),
    ("along the notch", NOTCHED, [(2, 1), (5, 2), (8, 1)], True, True),
    ("passes through", HOLED, [(-5, 1), (15, 2)], True, False),
    ("within the hole", HOLED, [(4.5, 4.5), (5, 5)], False, False),
    ("apart", HOLED, [(20, 0), (30, 40)], False, False),
    ("its box meets, it does not", [ring((0, 0), (10, 0), (0, 10))], [(10, 9), (9, 10)], False, False),
    ("without length, inside", HOLED, [(1, 1), (1, 1)], True, True),
]


@pytest.fixture(scope="module")
def areas(spark):
    return spark.createDataFrame([a[:3] for a in AREAS], f"name string, polygon {RINGS}, shape {RINGS}").persist()


@pytest.fixture(scope="module")
def lines(spark):
    rows = [(n, p, [{"x": float(x), "y": float(y)} for x, y in path]) for n, p, path, *_ in LINES]
    return spark.createDataFrame(rows, f"name string, polygon {RINGS}, path {PATH}").persist()


def results(frame, own, area):
    polygon = G.edges(F.col("polygon"))
    rows = frame.select("name", G.shapes_meet(own, polygon, area).alias("m"), G.lies_within(own, polygon, area).alias("w"))
    return {r.name: (r.m, r.w) for r in rows.collect()}


def test_areas(areas):
    assert results(areas, G.edges(F.col("shape")), True) == {a[0]: a[3:] for a in AREAS}


def test_lines(lines):
    assert results(lines, G.path_edges(F.col("path")), False) == {a[0]: a[3:] for a in LINES}


@pytest.mark.parametrize("algorithm", ["broadcast", "pbsm"])
@pytest.mark.parametrize("predicate, place", [("intersects", 3), ("contains", 4)])
def test_join(spark, areas, lines, algorithm, predicate, place):
    polygon = spark.createDataFrame([(1, HOLED), (2, None), (3, [])], f"pid int, rings {RINGS}")
    shapes = areas.where(F.col("name") != "fills the hole").select("name", F.col("shape").alias("other"))
    found = sj.shape_join(polygon, shapes, predicate, right_shape="other", algorithm=algorithm)
    assert found.columns == ["pid", "name"]
    wanted = [a[0] for a in AREAS if a[1] is HOLED and a[place] and a[0] != "fills the hole"]
    got = [r.name for r in found.collect()]
    assert sorted(n for n in got if n in {a[0] for a in AREAS if a[1] is HOLED}) == sorted(wanted)
    found = sj.shape_join(polygon, lines.select("name", "path"), predicate, algorithm=algorithm)
    got = {r.name for r in found.collect()}
    assert {n for n in got if n in {a[0] for a in LINES if a[1] is HOLED and a[0] not in ("inside", "within the hole", "apart")}} == {
        a[0] for a in LINES if a[1] is HOLED and a[place] and a[0] not in ("inside", "within the hole", "apart")}


@pytest.mark.parametrize("predicate", ["intersects", "contains"])
@pytest.mark.parametrize("shape", ["path", "shape"])
def test_crowded_cells_of_a_join_are_split(spark, areas, lines, monkeypatch, predicate, shape):
    polygon = spark.createDataFrame([(i, HOLED) for i in range(6)], f"pid int, rings {RINGS}")
    others = (lines if shape == "path" else areas).select("name", F.col(shape).alias("other"))
    whole = sj.shape_join(polygon, others, predicate, right_shape="other", algorithm="pbsm").collect()
    monkeypatch.setattr(sj, "HOT_ROWS", 3)
    split = sj.shape_join(polygon, others, predicate, right_shape="other", algorithm="pbsm").collect()
    assert whole and sorted(split) == sorted(whole)


def test_join_refuses_what_it_cannot_decide(spark, lines):
    with pytest.raises(ValueError, match="predicate"):
        sj.shape_join(lines.select("path"), lines.select(F.col("path").alias("p")), "contains", left_shape="path", right_shape="p")
    with pytest.raises(ValueError, match="rings or paths"):
        sj.shape_join(lines.select("path"), lines.select("name"), left_shape="path", right_shape="name")


def test_range_query_by_polygon(spark, lines):
    outline = [[(p["x"], p["y"]) for p in r] for r in HOLED]
    wanted = {p: sorted(a[0] for a in LINES if a[1] is HOLED and a[i]) for p, i in (("intersects", 3), ("contains", 4))}
    names = [a[0] for a in LINES if a[1] is HOLED]
    for predicate, expected in wanted.items():
        found = vector.within_polygon(lines.where(F.col("name").isin(names)), outline, predicate)
        mine = found.where(F.size("polygon") == 2)
        assert sorted(r.name for r in mine.collect()) == expected
    boxes = spark.createDataFrame([(1, 1.0, 1.0, 2.0, 2.0), (2, 4.5, 4.5, 5.0, 5.0), (3, 9.0, 9.0, 12.0, 12.0)],
                                  "id int, minx double, miny double, maxx double, maxy double")
    for predicate, expected in (("intersects", [1, 3]), ("contains", [1])):
        assert sorted(r.id for r in vector.within_polygon(boxes, outline, predicate).collect()) == expected
    mixed = spark.createDataFrame(
        [("point", "Point", 1.0, 1.0, None), ("line", "LineString", None, None, [ring((1, 5), (9, 5))[:2]]),
         ("area", "Polygon", None, None, [square(1, 1, 2)])],
        f"name string, geom_type string, x double, y double, rings {RINGS}",
    )
    mixed = vector.with_envelope(mixed)
    for predicate, expected in (("intersects", ["area", "line", "point"]), ("contains", ["area", "point"])):
        assert sorted(r.name for r in vector.within_polygon(mixed, outline, predicate).collect()) == expected


def test_lines_on_the_border_of_a_rectangle(spark):
    box = G.Box(0.0, 0.0, 1.0, 1.0)
    ways = {"two sides": [(0, 0), (1, 0), (1, 1)], "one side": [(0, 0.2), (0, 0.8)], "around": [(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)],
            "across": [(0, 0), (1, 1)], "side, then in": [(0, 0), (1, 0), (0.5, 0.5)], "leaves": [(0.5, 0.5), (2, 2)]}
    rows = [(n, [{"x": float(x), "y": float(y)} for x, y in w]) for n, w in ways.items()]
    lines = spark.createDataFrame(rows, f"name string, path {PATH}")
    want = {"across", "side, then in"}
    assert {r.name for r in vector.range_query(lines, box, "contains").collect()} == want
    mixed = lines.select("name", F.lit("LineString").alias("geom_type"), F.array("path").alias("rings"), F.lit(None).cast("double").alias("x"), F.lit(None).cast("double").alias("y"))
    assert {r.name for r in vector.range_query(vector.with_envelope(mixed), box, "contains").collect()} == want
    outline = [[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0), (0.0, 0.0)]]
    assert {r.name for r in vector.within_polygon(lines, outline, "contains").collect()} == want


def test_a_long_line_is_compared_with_shapes_beside_it_only(spark):
    places = [(x + 0.5, y + 0.5) for x in range(0, 60, 3) for y in range(0, 60, 3)]
    shapes = spark.createDataFrame([(i, [square(x, y, 1)]) for i, (x, y) in enumerate(places)], f"pid int, rings {RINGS}")
    ways = [[(0, 0), (60, 60)], [(0, 30), (60, 31)], [(1, 1), (1.2, 1.2)]]
    lines = spark.createDataFrame([(i, [{"x": float(x), "y": float(y)} for x, y in w]) for i, w in enumerate(ways)], f"id int, path {PATH}")
    a, b = sj._shape_rows(shapes, "rings", True, "_a"), sj._shape_rows(lines, "path", False, "_b")
    met = sj.edges_at_cells(sj._index_of(a, "_a", True, 1e-12), b, "_b")
    assert met.select("_a").distinct().count() < len(places) / 4
    found = {(r.pid, r.id) for r in sj.shape_join(shapes, lines).collect()}
    assert found == {(i, 0) for i, (x, y) in enumerate(places) if x == y} | {(0, 2)} | {
        (i, 1) for i, (x, y) in enumerate(places) if y <= 30 + (x + 1) / 60 and y + 1 >= 30 + x / 60}
