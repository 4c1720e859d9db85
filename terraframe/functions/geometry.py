"""Geometry as plain nested columns.

A ring or a line is ``array<struct<x:double,y:double>>``; a polygon is an array of
closed rings, the shell first and holes in the opposite direction. Only primitive
and nested Spark types are used, so scans prune them and Catalyst sees them.
Inside tests work on *edges*, ``array<struct<x1,y1,x2,y2>>``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Distance below which a point counts as lying on an edge (coordinate units).
BORDER = 1e-12


@dataclass(frozen=True)
class Box:
    """A closed rectangle, given as west, south, east, north."""

    minx: float
    miny: float
    maxx: float
    maxy: float

    @classmethod
    def parse(cls, text: str) -> Box:
        """From ``"x_min,y_min,x_max,y_max"``."""
        parts = [float(p) for p in text.split(",")]
        if len(parts) != 4:
            raise ValueError(f"a box needs four numbers, got {text!r}")
        return cls(*parts)

    def ring(self) -> Column:
        """The rectangle as a closed ring."""
        corners = [
            (self.minx, self.miny), (self.maxx, self.miny), (self.maxx, self.maxy),
            (self.minx, self.maxy), (self.minx, self.miny),
        ]
        return F.array(*[point(F.lit(x), F.lit(y)) for x, y in corners])


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def line(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """A two-point line."""
    return F.array(point(x1, y1), point(x2, y2))


def path_edges(path: Column) -> Column:
    """Consecutive point pairs of one ring or line."""
    pairs = F.zip_with(
        F.slice(path, 1, F.greatest(F.size(path) - 1, F.lit(0))),
        F.slice(path, 2, F.greatest(F.size(path) - 1, F.lit(0))),
        lambda a, b: F.struct(
            a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")
        ),
    )
    return pairs


def edges(rings: Column) -> Column:
    """All edges of a polygon (or of a multi-part line) in one array."""
    return F.flatten(F.transform(rings, path_edges))


def envelope(rings: Column) -> dict[str, Column]:
    """The bounding box as four columns."""
    xs = F.flatten(F.transform(rings, lambda r: F.transform(r, lambda p: p["x"])))
    ys = F.flatten(F.transform(rings, lambda r: F.transform(r, lambda p: p["y"])))
    return {
        "minx": F.array_min(xs), "miny": F.array_min(ys),
        "maxx": F.array_max(xs), "maxy": F.array_max(ys),
    }


def path_length(path: Column) -> Column:
    return _total(path_edges(path), lambda e: F.hypot(e["x2"] - e["x1"], e["y2"] - e["y1"]))


def _total(items: Column, value) -> Column:
    return F.aggregate(items, F.lit(0.0), lambda acc, item: acc + value(item))


def line_centroid(path: Column) -> Column:
    """Mean of the segment midpoints, weighted by length."""
    return _weighted(
        path_edges(path),
        lambda e: F.hypot(e["x2"] - e["x1"], e["y2"] - e["y1"]),
        lambda e: (e["x1"] + e["x2"]) / 2,
        lambda e: (e["y1"] + e["y2"]) / 2,
        path[0],
    )


def polygon_centroid(rings: Column) -> Column:
    """Area-weighted centroid; holes count negative through their direction.

    Coordinates are taken relative to the first vertex, which keeps digits for
    small shapes far from the origin. A shape without area gets the centroid of
    its outline.
    """
    first = rings[0][0]

    def cross(e: Column) -> Column:
        return (e["x1"] - first["x"]) * (e["y2"] - first["y"]) - (e["x2"] - first["x"]) * (
            e["y1"] - first["y"]
        )

    return _weighted(
        edges(rings),
        cross,
        lambda e: (first["x"] + e["x1"] + e["x2"]) / 3,
        lambda e: (first["y"] + e["y1"] + e["y2"]) / 3,
        line_centroid(rings[0]),
    )


def _weighted(items: Column, weight, x, y, otherwise: Column) -> Column:
    zero = F.struct(F.lit(0.0).alias("w"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    return F.aggregate(
        items,
        zero,
        lambda acc, e: F.struct(
            (acc["w"] + weight(e)).alias("w"),
            (acc["x"] + weight(e) * x(e)).alias("x"),
            (acc["y"] + weight(e) * y(e)).alias("y"),
        ),
        lambda acc: F.when(
            acc["w"] != 0, point(acc["x"] / acc["w"], acc["y"] / acc["w"])
        ).otherwise(otherwise),
    )


def crossings(outline: Column, px: Column, py: Column) -> Column:
    """Number of edges that a ray from the point towards +x crosses."""

    def crossed(e: Column) -> Column:
        side = (e["x2"] - e["x1"]) * (py - e["y1"]) - (px - e["x1"]) * (e["y2"] - e["y1"])
        spans = (e["y1"] > py) != (e["y2"] > py)
        return spans & F.when(e["y2"] > e["y1"], side > 0).otherwise(side < 0)

    return F.size(F.filter(outline, crossed))


def _side(e: Column, px: Column, py: Column) -> Column:
    """Twice the signed area of an edge and a point: positive if the point is to the left."""
    return (e["x2"] - e["x1"]) * (py - e["y1"]) - (px - e["x1"]) * (e["y2"] - e["y1"])


def in_edge_box(e: Column, px: Column, py: Column, tol: float) -> Column:
    """Whether a point lies within ``tol`` of the box of an edge."""
    slack = F.lit(tol)
    return (
        (py >= F.least(e["y1"], e["y2"]) - slack)
        & (py <= F.greatest(e["y1"], e["y2"]) + slack)
        & (px >= F.least(e["x1"], e["x2"]) - slack)
        & (px <= F.greatest(e["x1"], e["x2"]) + slack)
    )


def reach(e: Column, tol: float) -> Column:
    """How far from zero ``side`` may be for a point within ``tol`` of the line of an edge."""
    return F.lit(tol) * F.hypot(e["x2"] - e["x1"], e["y2"] - e["y1"])


def _touches(e: Column, px: Column, py: Column, tol: float) -> Column:
    return in_edge_box(e, px, py, tol) & (F.abs(_side(e, px, py)) <= reach(e, tol))


def on_border(outline: Column, px: Column, py: Column, tol: float = BORDER) -> Column:
    """Whether the point lies within ``tol`` of an edge."""
    return F.exists(outline, lambda e: _touches(e, px, py, tol))


def point_matches(outline: Column, px: Column, py: Column, predicate: str, tol: float = BORDER) -> Column:
    """``contains``: strictly inside. ``intersects``: inside or on the border."""
    odd = crossings(outline, px, py) % 2 == 1
    if predicate == "contains":
        return odd & ~on_border(outline, px, py, tol)
    if predicate == "intersects":
        return odd | on_border(outline, px, py, tol)
    raise ValueError(f"predicate must be 'contains' or 'intersects', not {predicate!r}")


def shapes_meet(
    a: Column, b: Column, a_area: Column | bool = True, b_area: Column | bool = True, tol: float = BORDER
) -> Column:
    """Whether two outlines (with their insides, where they are areas) share a point."""

    def apart(e: Column, f: Column) -> Column:
        return (
            (F.greatest(e["x1"], e["x2"]) < F.least(f["x1"], f["x2"]) - tol)
            | (F.least(e["x1"], e["x2"]) > F.greatest(f["x1"], f["x2"]) + tol)
            | (F.greatest(e["y1"], e["y2"]) < F.least(f["y1"], f["y2"]) - tol)
            | (F.least(e["y1"], e["y2"]) > F.greatest(f["y1"], f["y2"]) + tol)
        )

    def meet(e: Column, f: Column) -> Column:
        ends = [_touches(f, e["x1"], e["y1"], tol), _touches(f, e["x2"], e["y2"], tol),
                _touches(e, f["x1"], f["y1"], tol), _touches(e, f["x2"], f["y2"], tol)]
        across = ((_side(f, e["x1"], e["y1"]) > 0) != (_side(f, e["x2"], e["y2"]) > 0)) & (
            (_side(e, f["x1"], f["y1"]) > 0) != (_side(e, f["x2"], f["y2"]) > 0)
        )
        return ~apart(e, f) & (across | ends[0] | ends[1] | ends[2] | ends[3])

    def holds(outline: Column, other: Column) -> Column:
        # Where no edges meet, each part of the other shape is wholly inside or outside.
        return F.exists(other, lambda e: crossings(outline, e["x1"], e["y1"]) % 2 == 1)

    found = F.exists(a, lambda e: F.exists(b, lambda f: meet(e, f)))
    for area, outline, other in ((a_area, a, b), (b_area, b, a)):
        if area is not False:
            found = found | (holds(outline, other) if area is True else area & holds(outline, other))
    return found


def _pieces(outline: Column, cutter: Column, tol: float) -> Column:
    """The edges of an outline cut where they meet another one: midpoint and direction of each piece."""

    def cuts(e: Column) -> Column:
        dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]

        def at(f: Column) -> Column:
            fx, fy = f["x2"] - f["x1"], f["y2"] - f["y1"]
            gx, gy = f["x1"] - e["x1"], f["y1"] - e["y1"]
            det = dx * fy - dy * fx
            beside = F.try_divide(gx * dy - gy * dx, det).between(-1e-9, 1 + 1e-9)
            along = F.when(_touches(e, f["x1"], f["y1"], tol), F.try_divide(gx * dx + gy * dy, dx * dx + dy * dy))
            return F.array(F.when(beside, F.try_divide(gx * fy - gy * fx, det)), along)

        inner = F.filter(F.flatten(F.transform(cutter, at)), lambda t: (t > 0) & (t < 1))
        return F.array_sort(F.concat(F.array(F.lit(0.0)), inner, F.array(F.lit(1.0))))

    def split(e: Column) -> Column:
        dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]

        def between(t: Column) -> Column:
            steps = F.zip_with(
                F.slice(t, 1, F.size(t) - 1), F.slice(t, 2, F.size(t) - 1),
                lambda low, high: F.struct(((low + high) / 2).alias("t"), (high - low).alias("share")),
            )
            return F.transform(
                F.filter(steps, lambda s: s["share"] > 1e-9),
                lambda s: F.struct(
                    (e["x1"] + s["t"] * dx).alias("x"), (e["y1"] + s["t"] * dy).alias("y"),
                    (s["share"] * dx).alias("dx"), (s["share"] * dy).alias("dy"),
                ),
            )

        return F.flatten(F.transform(F.array(cuts(e)), between))

    return F.flatten(F.transform(outline, split))


def lies_within(shape: Column, polygon: Column, area: Column | bool = True, tol: float = BORDER) -> Column:
    """Whether nothing of a line or area is outside a polygon and some of it is off the border.

    All edges are cut where the two outlines meet, so each piece is on one side as a whole. Of an area, the inner side of
    each piece is looked at, a millionth of its length away; narrower gaps are not seen.
    """
    own = _pieces(shape, polygon, tol)
    line = F.forall(own, lambda m: point_matches(polygon, m["x"], m["y"], "intersects", tol)) & F.exists(
        own, lambda m: point_matches(polygon, m["x"], m["y"], "contains", tol)
    )
    if area is False:
        return line

    def inner_side(m: Column) -> Column:
        step = 1e-6
        left, right = ((m["x"] - s * m["dy"], m["y"] + s * m["dx"]) for s in (step, -step))
        in_left = crossings(shape, *left) % 2 == 1
        return F.when(in_left, crossings(polygon, *left)).otherwise(crossings(polygon, *right)) % 2 == 1

    whole = F.forall(own, inner_side) & ~F.exists(
        _pieces(polygon, shape, tol), lambda m: point_matches(shape, m["x"], m["y"], "contains", tol)
    )
    return whole if area is True else F.when(area, whole).otherwise(line)


def edge_in_box(e: Column, minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    """Whether an edge meets a closed rectangle: its box does, and the corners are not all on one side of it."""
    sides = [_side(e, x, y) for x in (minx, maxx) for y in (miny, maxy)]
    return (
        (F.least(e["x1"], e["x2"]) <= maxx)
        & (F.greatest(e["x1"], e["x2"]) >= minx)
        & (F.least(e["y1"], e["y2"]) <= maxy)
        & (F.greatest(e["y1"], e["y2"]) >= miny)
        & (F.least(*sides) <= 0)
        & (F.greatest(*sides) >= 0)
    )


def any_edge_in_box(outline: Column, minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    """Whether an edge meets a closed rectangle."""
    return F.exists(outline, lambda e: edge_in_box(e, minx, miny, maxx, maxy))


def edges_meet(e: Column, f: Column, tol: float = BORDER) -> Column:
    """Whether two edges share a point."""
    apart = (
        (F.greatest(e["x1"], e["x2"]) < F.least(f["x1"], f["x2"]) - tol)
        | (F.least(e["x1"], e["x2"]) > F.greatest(f["x1"], f["x2"]) + tol)
        | (F.greatest(e["y1"], e["y2"]) < F.least(f["y1"], f["y2"]) - tol)
        | (F.least(e["y1"], e["y2"]) > F.greatest(f["y1"], f["y2"]) + tol)
    )
    ends = (
        _touches(f, e["x1"], e["y1"], tol) | _touches(f, e["x2"], e["y2"], tol)
        | _touches(e, f["x1"], f["y1"], tol) | _touches(e, f["x2"], f["y2"], tol)
    )
    across = ((_side(f, e["x1"], e["y1"]) > 0) != (_side(f, e["x2"], e["y2"]) > 0)) & (
        (_side(e, f["x1"], f["y1"]) > 0) != (_side(e, f["x2"], f["y2"]) > 0)
    )
    return ~apart & (across | ends)


def changes_side(e: Column, x0: Column, y0: Column, x: Column, y: Column) -> Column:
    """Whether an edge lies an odd number of times on the way from one point to another, first up or down, then across."""

    def above(px: Column, py: Column) -> Column:
        side = _side(e, px, py)
        return ((e["x1"] > px) != (e["x2"] > px)) & F.when(e["x2"] > e["x1"], side < 0).otherwise(side > 0)

    def right(px: Column, py: Column) -> Column:
        side = _side(e, px, py)
        return ((e["y1"] > py) != (e["y2"] > py)) & F.when(e["y2"] > e["y1"], side > 0).otherwise(side < 0)

    return (above(x0, y0) != above(x0, y)) != (right(x0, y) != right(x, y))


def parity_at(outline: Column, odd: Column, x0: Column, y0: Column, x: Column, y: Column) -> Column:
    """Whether a point is inside, from what is known of another point and the edges on the way to it."""
    return (F.size(F.filter(outline, lambda e: changes_side(e, x0, y0, x, y))) % 2 == 1) != odd


def cuts_of(e: Column, cutter: Column, tol: float) -> Column:
    """Where along an edge, from 0 to 1, the edges of another outline cut or touch it."""
    dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]

    def at(f: Column) -> Column:
        fx, fy = f["x2"] - f["x1"], f["y2"] - f["y1"]
        gx, gy = f["x1"] - e["x1"], f["y1"] - e["y1"]
        det = dx * fy - dy * fx
        beside = F.try_divide(gx * dy - gy * dx, det).between(-1e-9, 1 + 1e-9)

        def along(x: Column, y: Column) -> Column:
            hx, hy = x - e["x1"], y - e["y1"]
            return F.when(_touches(e, x, y, tol), F.try_divide(hx * dx + hy * dy, dx * dx + dy * dy))

        return F.array(
            F.when(beside, F.try_divide(gx * fy - gy * fx, det)), along(f["x1"], f["y1"]), along(f["x2"], f["y2"])
        )

    return F.flatten(F.transform(cutter, at))


def side(e: Column, px: Column, py: Column) -> Column:
    """Twice the signed area of an edge and a point: positive if the point is to the left."""
    return _side(e, px, py)


def touches(e: Column, px: Column, py: Column, tol: float = BORDER) -> Column:
    """Whether a point lies within ``tol`` of an edge."""
    return _touches(e, px, py, tol)


def leaves_border(outline: Column, box: Box) -> Column:
    """Whether edges within a closed rectangle are not all on its border."""

    def along(e: Column) -> Column:
        sides = [("x1", "x2", box.minx), ("x1", "x2", box.maxx), ("y1", "y2", box.miny), ("y1", "y2", box.maxy)]
        on = F.lit(False)
        for a, b, value in sides:
            on = on | ((e[a] == value) & (e[b] == value))
        return on

    return F.exists(outline, lambda e: ~along(e))


def touches_box(outline: Column, box: Box, area: Column | bool = True) -> Column:
    """Whether an outline (with its inside, if ``area``) meets a closed rectangle."""
    hit = any_edge_in_box(outline, *[F.lit(v) for v in (box.minx, box.miny, box.maxx, box.maxy)])
    if area is False:
        return hit
    covered = crossings(outline, F.lit(box.minx), F.lit(box.miny)) % 2 == 1
    return hit | (covered if area is True else area & covered)


def wkt_point(x: Column, y: Column) -> Column:
    return F.format_string("POINT (%s %s)", x, y)


def _wkt_path(path: Column) -> Column:
    return F.concat(
        F.lit("("),
        F.array_join(
            F.transform(path, lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"))),
            ", ",
        ),
        F.lit(")"),
    )


def _wkt_paths(paths: Column) -> Column:
    return F.concat(F.lit("("), F.array_join(F.transform(paths, _wkt_path), ", "), F.lit(")"))


def wkt_line(path: Column) -> Column:
    return F.concat(F.lit("LINESTRING "), _wkt_path(path))


def wkt_lines(paths: Column) -> Column:
    return F.concat(F.lit("MULTILINESTRING "), _wkt_paths(paths))


def wkt_polygon(rings: Column) -> Column:
    return F.concat(F.lit("POLYGON "), _wkt_paths(rings))


def wkt_polygons(rings: Column) -> Column:
    parts = F.array_join(F.transform(polygons_of(rings), _wkt_paths), ", ")
    return F.concat(F.lit("MULTIPOLYGON ("), parts, F.lit(")"))


def ring_area(ring: Column) -> Column:
    """Signed area, positive for a counter-clockwise ring."""
    return _total(path_edges(ring), lambda e: (e["x1"] * e["y2"] - e["x2"] * e["y1"]) / 2)


def polygons_of(rings: Column) -> Column:
    """Rings of a multipolygon grouped to polygons.

    Rings that turn like the first one are shells; the others are holes of the shell
    before them.
    """
    turn = F.signum(ring_area(rings[0]))

    def add(done: Column, ring: Column) -> Column:
        shell = (F.size(done) == 0) | (F.signum(ring_area(ring)) == turn)
        with_hole = F.concat(
            F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))),
            F.array(F.concat(F.element_at(done, -1), F.array(ring))),
        )
        return F.when(shell, F.concat(done, F.array(F.array(ring)))).otherwise(with_hole)

    empty = F.array().cast("array<array<array<struct<x:double,y:double>>>>")
    return F.aggregate(rings, empty, add)


def _path_from_text(text: Column) -> Column:
    """Points of ``"x y, x y"``; a bad number fails the job."""

    def parse(pair: Column) -> Column:
        numbers = F.split(F.trim(pair), r"\s+")
        return point(numbers[0], numbers[1])

    return F.transform(F.split(text, ","), parse)


def by_role(polygons: Column) -> Column:
    """Rings of polygons in one array: shells counter-clockwise, holes clockwise, whatever way they came.

    ``polygons`` holds rings by position, the shell of each polygon first.
    """

    def turned(ring: Column, position: Column) -> Column:
        area = ring_area(ring)
        return F.when(F.when(position == 0, area < 0).otherwise(area > 0), F.reverse(ring)).otherwise(ring)

    return F.flatten(F.transform(polygons, lambda rings: F.transform(rings, turned)))


def rings_from_wkt(wkt: Column) -> Column:
    """Rings of a POLYGON or MULTIPOLYGON (parts flattened, turned by role), or the paths of lines."""
    body = F.regexp_replace(F.regexp_replace(wkt, r"^[^(]*[(\s]+", ""), r"[)\s]+$", "")
    parts = F.transform(
        F.split(body, r"\)\s*\)\s*,\s*\(\s*\("),
        lambda part: F.transform(F.split(part, r"\)\s*,\s*\("), _path_from_text),
    )
    return F.when(wkt.rlike(r"(?i)^\s*(MULTI)?POLYGON"), by_role(parts)).otherwise(F.flatten(parts))
