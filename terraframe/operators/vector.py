"""Vector operators on feature tables.

A feature table has attribute columns and geometry columns: ``x, y`` for points,
``rings`` for polygons, ``path`` for lines, ``minx, miny, maxx, maxy`` for boxes.
Tables of mixed geometry name the type of each row in ``geom_type`` and keep the
parts of lines in ``rings`` too.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions.geometry import Box

BOX = ("minx", "miny", "maxx", "maxy")
GEOMETRY = ("geom_type", "x", "y", "rings", "path", *BOX)


def with_envelope(features: DataFrame) -> DataFrame:
    """Add the box columns, so that range filters reach the scan once stored."""
    if "rings" in features.columns:
        box = G.envelope(F.col("rings"))
        if "x" in features.columns:
            box = {n: F.coalesce(c, F.col("x" if n.endswith("x") else "y")) for n, c in box.items()}
        return features.withColumns(box)
    if "path" in features.columns:
        return features.withColumns(G.envelope(F.array("path")))
    return features.withColumns({"minx": F.col("x"), "miny": F.col("y"), "maxx": F.col("x"), "maxy": F.col("y")})


def in_range(features: DataFrame, box: Box, predicate: str = "intersects") -> Column:
    """Condition that a feature of the table meets (or lies strictly inside) a rectangle."""
    if predicate not in ("intersects", "contains"):
        raise ValueError(f"predicate must be 'contains' or 'intersects', not {predicate!r}")
    names = features.columns
    shaped = "rings" in names or "path" in names
    c = F.col
    if "minx" in names or shaped:
        sides = {n: c(n) for n in BOX}
        if "minx" not in names:
            sides = G.envelope(c("rings") if "rings" in names else F.array("path"))
        minx, miny, maxx, maxy = (sides[n] for n in BOX)
    else:
        minx, miny, maxx, maxy = c("x"), c("y"), c("x"), c("y")
    if predicate == "contains":
        meets = (maxx > box.minx) & (minx < box.maxx) & (maxy > box.miny) & (miny < box.maxy)
        within = meets & (minx >= box.minx) & (maxx <= box.maxx) & (miny >= box.miny) & (maxy <= box.maxy)
        # A line can run along several sides of the border; an area within the box has an inside.
        if "rings" in names and "geom_type" in names:
            is_area = F.lower("geom_type").like("%polygon")
            return within & (c("rings").isNull() | is_area | G.leaves_border(G.edges(c("rings")), box))
        if "path" in names:
            return within & G.leaves_border(G.path_edges(c("path")), box)
        return within
    near = (minx <= box.maxx) & (maxx >= box.minx) & (miny <= box.maxy) & (maxy >= box.miny)
    if "rings" in names:
        area = F.lower("geom_type").like("%polygon") if "geom_type" in names else True
        return near & (c("rings").isNull() | G.touches_box(G.edges(c("rings")), box, area))
    if "path" in names:
        return near & G.touches_box(G.path_edges(c("path")), box, area=False)
    return near


def range_query(features: DataFrame, box: Box, predicate: str = "intersects") -> DataFrame:
    """Features in a rectangle.

    ``intersects`` takes the border in (the range query); ``contains`` asks for
    features of which nothing is outside and some part is off the border. Comparisons on stored columns are pushed into the scan;
    lines and polygons get the exact test after the box test.
    """
    return features.where(in_range(features, box, predicate))


def within_polygon(
    features: DataFrame, rings: list[list[tuple[float, float]]], predicate: str = "contains", tol: float = G.BORDER
) -> DataFrame:
    """Features in one given polygon (closed rings of coordinates).

    ``contains`` asks for features of which nothing is outside and some part is off the border, ``intersects`` for a
    common point. The box of the polygon is tested first, on plain columns where they are stored.
    """
    corners = [p for ring in rings for p in ring]
    box = Box(*[f(p[i] for p in corners) for f, i in ((min, 0), (min, 1), (max, 0), (max, 1))])
    outline = F.flatten(
        F.array(*[G.path_edges(F.array(*[G.point(F.lit(float(x)), F.lit(float(y))) for x, y in r])) for r in rings])
    )
    near = features.where(in_range(features, Box(box.minx - tol, box.miny - tol, box.maxx + tol, box.maxy + tol)))
    return near.where(_matches_polygon(features, outline, predicate, tol))


def _matches_polygon(features: DataFrame, outline: Column, predicate: str, tol: float) -> Column:
    names = features.columns
    area: Column | bool = False
    if "rings" in names:
        area = F.lower("geom_type").like("%polygon") if "geom_type" in names else True
        own = G.edges(F.col("rings"))
    elif "path" in names:
        own = G.path_edges(F.col("path"))
    elif "x" in names:
        return G.point_matches(outline, F.col("x"), F.col("y"), predicate, tol)
    else:
        own, area = G.path_edges(_box_ring()), True
    if predicate == "intersects":
        shaped = G.shapes_meet(own, outline, area, True, tol)
    elif predicate == "contains":
        shaped = G.lies_within(own, outline, area, tol)
    else:
        raise ValueError(f"predicate must be 'contains' or 'intersects', not {predicate!r}")
    if "rings" in names and "x" in names:
        spot = G.point_matches(outline, F.col("x"), F.col("y"), predicate, tol)
        return F.when(F.col("rings").isNull(), spot).otherwise(shaped)
    return shaped


def _box_ring() -> Column:
    corners = [("minx", "miny"), ("maxx", "miny"), ("maxx", "maxy"), ("minx", "maxy"), ("minx", "miny")]
    return F.array(*[G.point(F.col(x), F.col(y)) for x, y in corners])


def count_features(features: DataFrame, alias: str = "n_features") -> DataFrame:
    return features.agg(F.count("*").alias(alias))


def reduce_to_2d(
    features: DataFrame,
    point: str | None = None,
    low: str | None = None,
    high: str | None = None,
) -> DataFrame:
    """Drop attributes and every ordinate after the second.

    ``point`` names a coordinate array; ``low`` and ``high`` name the two corner
    arrays of an N-dimensional box.
    """
    if point is not None:
        return features.select(F.get(F.col(point), F.lit(0)).alias("x"), F.get(F.col(point), F.lit(1)).alias("y"))
    if low is None or high is None:
        return features.select(*[c for c in features.columns if c in GEOMETRY])
    return features.select(
        F.get(F.col(low), F.lit(0)).alias("minx"), F.get(F.col(low), F.lit(1)).alias("miny"),
        F.get(F.col(high), F.lit(0)).alias("maxx"), F.get(F.col(high), F.lit(1)).alias("maxy"),
    )


def _vertices(features: DataFrame) -> Column:
    ordinates = F.when(F.col("x").isNotNull(), 1).otherwise(0) if "x" in features.columns else F.lit(0)
    if "rings" in features.columns:
        return F.coalesce(F.aggregate("rings", F.lit(0), lambda n, ring: n + F.size(ring)), ordinates)
    return F.size("path") if "path" in features.columns else ordinates


def _kind(features: DataFrame) -> Column:
    if "geom_type" in features.columns:
        return F.lower("geom_type")
    names = {"rings": "polygon", "path": "linestring", "x": "point"}
    return F.lit(next((kind for column, kind in names.items() if column in features.columns), "box"))


def summarize(features: DataFrame, **more: Column) -> DataFrame:
    """Counts, extent and average size of a feature set, in one pass.

    ``num_points`` counts vertices; the three ``*_features`` counts are by geometry type. Further aggregates can be
    taken along by name.
    """
    boxed = features if "minx" in features.columns else with_envelope(features)
    present = F.col("minx").isNotNull()
    kind = _kind(features)
    vertices = F.when(present, _vertices(features)).otherwise(0).cast("bigint")
    return boxed.agg(
        F.count("*").alias("num_features"),
        F.count("minx").alias("num_non_empty"),
        F.coalesce(F.sum(vertices), F.lit(0)).alias("num_points"),
        F.count(F.when(present & kind.like("%point"), 1)).alias("point_features"),
        F.count(F.when(present & kind.like("%linestring"), 1)).alias("line_features"),
        F.count(F.when(present & kind.like("%polygon"), 1)).alias("polygon_features"),
        F.min("minx").alias("minx"), F.min("miny").alias("miny"),
        F.max("maxx").alias("maxx"), F.max("maxy").alias("maxy"),
        F.avg(F.col("maxx") - F.col("minx")).alias("avg_width"),
        F.avg(F.col("maxy") - F.col("miny")).alias("avg_height"),
        *[aggregate.alias(name) for name, aggregate in more.items()],
    )


def summary_json(features: DataFrame, **more: Column) -> DataFrame:
    """The summary with the schema of the features, as one JSON text, beside it the extent and further aggregates."""
    schema = [
        {"name": f.name, "type": f.dataType.simpleString()} for f in features.schema.fields
        if f.name not in GEOMETRY
    ]
    summary = summarize(features, **more)
    return summary.select(
        F.to_json(
            F.struct(
                F.struct(*[c for c in summary.columns if c not in more]).alias("summary"),
                F.from_json(F.lit(json.dumps(schema)), "array<struct<name:string,type:string>>").alias("schema"),
            ),
            {"pretty": "true", "ignoreNullFields": "false"},
        ).alias("json"),
        *BOX, *more,
    )


def tag_points(joined: DataFrame, points: DataFrame, name: str, alias: str) -> DataFrame:
    """Point columns plus one polygon attribute as a string column."""
    return joined.select(*points.columns, F.col(name).cast("string").alias(alias))


def polygon_then_point(joined: DataFrame, polygons: DataFrame, points: DataFrame) -> DataFrame:
    """Polygon attributes, then point attributes, then the point geometry."""
    ours = [c for c in polygons.columns if c not in GEOMETRY]
    theirs = [c for c in points.columns if c not in GEOMETRY]
    return joined.select(*ours, *theirs, "x", "y")
