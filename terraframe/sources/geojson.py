"""GeoJSON features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..operators.vector import with_envelope

RING = "array<array<double>>"


def _points(positions: Column) -> Column:
    return F.transform(positions, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))


def _geometry(kind: Column, coordinates: Column) -> tuple[Column, Column, Column]:
    """``x``, ``y`` and ``rings`` by geometry type, from the JSON text of the coordinates."""

    def parsed(ddl: str) -> Column:
        return F.from_json(coordinates, ddl, {"mode": "FAILFAST"})

    position = parsed("array<double>")
    rings = (
        F.when(kind == "LineString", F.array(_points(parsed(RING))))
        .when(kind == "MultiLineString", F.transform(parsed(f"array<{RING}>"), _points))
        .when(kind == "Polygon", G.by_role(F.array(F.transform(parsed(f"array<{RING}>"), _points))))
        .when(kind == "MultiPolygon", G.by_role(F.transform(parsed(f"array<array<{RING}>>"), lambda p: F.transform(p, _points))))
        .when(kind.isNull() | (kind == "Point"), F.lit(None))
        .otherwise(F.raise_error(F.concat(F.lit("unsupported GeoJSON geometry: "), kind)))
    )
    x, y = (F.when(kind == "Point", F.get(position, F.lit(i))) for i in (0, 1))
    return x, y, rings


def load_geojson(
    spark: SparkSession, path: str, properties: str | None = None, layout: str = "lines"
) -> DataFrame:
    """Features with ``geom_type, x, y, rings``, their box, and their properties.

    ``properties`` is a DDL string whose fields become columns; without it they stay
    one ``map<string,string>`` column. Layout ``lines`` wants one feature per line (either
    plain line-delimited features or a collection written that way; anything else raises an
    error) and splits large files over tasks. Layout ``collection`` reads whole documents
    of any layout, one task per file.
    """
    if layout == "collection":
        files = spark.read.schema(f"type string, features array<{_feature_type(properties)}>")
        features = files.option("mode", "FAILFAST").json(path, multiLine=True).select(F.explode("features").alias("f"))
    elif layout == "lines":
        text, mark = F.trim("value"), r'"type"\s*:\s*"Feature"'
        # Only blank lines and the lines that open or close a collection hold no feature.
        frame = r'^(\{|"type"\s*:\s*"FeatureCollection"\s*,?|"(name|bbox|crs)"\s*:.*,?|"features"\s*:\s*\[|\]\s*,?|\}|\]\s*\})?$'
        opening = r'^\{\s*"type"\s*:\s*"FeatureCollection"[^{]*("crs".*)?\[$'
        lines = spark.read.text(path).where(~text.rlike(frame) & ~text.rlike(opening))
        # A collection written line by line has its head before the first feature,
        # commas between them and its tail after the last one.
        single = F.regexp_replace(text, r'^\{\s*"type"\s*:\s*"FeatureCollection".*?\[\s*(?=\{)', "")
        single = F.regexp_replace(F.regexp_replace(single, r",$", ""), r"\}\s*\]\s*\}$", "}")
        crowded = F.raise_error(F.lit("several features on one line; use the 'collection' layout"))
        none = F.raise_error(F.concat(F.lit("a line without a feature: "), F.substring("value", 1, 80)))
        marks = F.regexp_count("value", F.lit(mark))
        single = F.when(marks > 1, crowded).when(marks == 0, none).otherwise(single)
        return parse_geojson(lines.select(single.alias("value")), properties)
    else:
        raise ValueError(f"layout must be 'collection' or 'lines', not {layout!r}")
    return _tabulate(features, properties)


def _feature_type(properties: str | None) -> str:
    ddl = f"struct<{properties}>" if properties else "map<string,string>"
    return f"struct<type:string,geometry:struct<type:string,coordinates:string>,properties:{ddl}>"


def parse_geojson(lines: DataFrame, properties: str | None = None, line: str = "value") -> DataFrame:
    """Features from a column that holds one GeoJSON feature per row."""
    parsed = F.from_json(F.col(line), _feature_type(properties), {"mode": "FAILFAST"})
    return _tabulate(lines.select(parsed.alias("f")), properties)


def _tabulate(features: DataFrame, properties: str | None) -> DataFrame:
    kind = F.col("f.geometry.type")
    x, y, rings = _geometry(kind, F.col("f.geometry.coordinates"))
    attributes = "f.properties.*" if properties else "f.properties"
    return with_envelope(
        features.select(attributes, kind.alias("geom_type"), x.alias("x"), y.alias("y"), rings.alias("rings"))
    )
