"""Loading and saving features by format name.

Readers and writers are looked up by short name in two small registries, which is
how a new format is added: ``register_reader("xyz", function, extension=".xyz")``.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions.geometry import Box
from ..operators.vector import BOX, GEOMETRY, range_query
from . import geojson, roads, shapefile

Reader = Callable[..., DataFrame]
_READERS: dict[str, Reader] = {}
_EXTENSIONS: dict[str, str] = {}
_WRITERS: dict[str, Callable[..., None]] = {}


def register_reader(name: str, reader: Reader, extension: str | None = None) -> None:
    """Make ``reader(spark, path, **options)`` available as format ``name``."""
    _READERS[name] = reader
    if extension:
        _EXTENSIONS[extension] = name


def register_writer(name: str, writer: Callable[..., None]) -> None:
    """Make ``writer(features, path, mode=..., **options)`` available as format ``name``."""
    _WRITERS[name] = writer


def options_for(options: Mapping[str, str], index: int) -> dict[str, str]:
    """Options of one of several inputs: ``name[i]`` applies to input ``i`` only and wins over ``name``."""
    general = {k: v for k, v in options.items() if not k.endswith("]")}
    suffix = f"[{index}]"
    own = {k[: -len(suffix)]: v for k, v in options.items() if k.endswith(suffix)}
    return {**general, **own}


def load_features(
    spark: SparkSession, path: str, fmt: str | None = None, filter_mbr: str | Box | None = None, **options: object
) -> DataFrame:
    """Features of any registered format; the format defaults to that of the extension.

    ``filter_mbr`` (``x_min,y_min,x_max,y_max``) keeps features that meet the
    rectangle. On Parquet the test is pushed into the scan, where row groups
    outside the rectangle are skipped.
    """
    fmt = fmt or _EXTENSIONS.get(os.path.splitext(path.rstrip("/"))[1].lower())
    if fmt not in _READERS:
        raise ValueError(f"unknown feature format {fmt!r}; known are {sorted(_READERS)}")
    features = _READERS[fmt](spark, path, **options)
    if filter_mbr is None:
        return features
    return range_query(features, Box.parse(filter_mbr) if isinstance(filter_mbr, str) else filter_mbr)


def save_features(features: DataFrame, path: str, fmt: str, overwrite: bool = False, **options: object) -> None:
    """Write features in any registered format; existing output is an error unless ``overwrite``."""
    if fmt not in _WRITERS:
        raise ValueError(f"unknown feature format {fmt!r}; known are {sorted(_WRITERS)}")
    _WRITERS[fmt](features, path, mode="overwrite" if overwrite else "errorifexists", **options)


def convert(
    spark: SparkSession, source: str, target: str, iformat: str | None = None, oformat: str = "parquet",
    overwrite: bool = False, **options: object,
) -> None:
    """Copy features from one format to another; ``options`` are those of the reader."""
    save_features(load_features(spark, source, iformat, **options), target, oformat, overwrite)


def _read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _read_points_csv(
    spark: SparkSession, path: str, x: str = "x", y: str = "y", sep: str = ";", schema: str | None = None
) -> DataFrame:
    rows = spark.read.csv(path, sep=sep, header=True, schema=schema, enforceSchema=False)
    return rows.withColumns({x: F.col(x).cast("double"), y: F.col(y).cast("double")}).withColumnsRenamed({x: "x", y: "y"})


def _read_wkt(spark: SparkSession, path: str, column: str = "geometry", sep: str = ";") -> DataFrame:
    """CSV with a header and a WKT column of points, lines or polygons."""
    rows = spark.read.csv(path, sep=sep, header=True)
    kind = F.upper(F.regexp_extract(column, r"^\s*([A-Za-z]+)", 1))
    rings = F.when(kind != "POINT", G.rings_from_wkt(F.col(column)))
    point = F.when(kind == "POINT", F.get(F.get(G.rings_from_wkt(F.col(column)), F.lit(0)), F.lit(0)))
    names = {"POINT": "Point", "LINESTRING": "LineString", "MULTILINESTRING": "MultiLineString",
             "POLYGON": "Polygon", "MULTIPOLYGON": "MultiPolygon"}
    known = F.create_map(*[F.lit(v) for pair in names.items() for v in pair])
    wrong = F.raise_error(F.concat(F.lit("unsupported WKT geometry: "), F.col(column))).cast("string")
    typed = rows.withColumns(
        {
            "geom_type": F.when(F.col(column).isNotNull(), F.coalesce(known[kind], wrong)),
            "x": point["x"], "y": point["y"], "rings": rings,
        }
    ).drop(column)
    box = G.envelope(F.col("rings"))
    return typed.withColumns({n: F.coalesce(c, F.col("x" if n.endswith("x") else "y")) for n, c in box.items()})


def _write_parquet(features: DataFrame, path: str, mode: str) -> None:
    features.write.mode(mode).parquet(path)


def write_csv_points(
    features: DataFrame, path: str, mode: str = "errorifexists", x_column: int = 0, y_column: int = 1,
    sep: str = ";", header: bool = True,
) -> None:
    """CSV with x and y at the given output positions and the attributes around them."""
    columns = [c for c in features.columns if c not in GEOMETRY]
    for position, name in sorted([(x_column, "x"), (y_column, "y")]):
        columns.insert(position, name)
    features.select(*columns).write.mode(mode).csv(path, sep=sep, header=header)


def geometry_wkt(features: DataFrame) -> Column:
    """WKT of whatever geometry columns the table has."""
    shapes = []
    if "rings" in features.columns:
        rings = F.col("rings")
        if "geom_type" in features.columns:
            kind = F.col("geom_type")
            shapes += [
                F.when((kind == "LineString") & (F.size(rings) == 1), G.wkt_line(rings[0])),
                F.when(kind.isin("LineString", "MultiLineString"), G.wkt_lines(rings)),
                F.when(kind == "MultiPolygon", G.wkt_polygons(rings)),
            ]
        shapes.append(F.when(rings.isNotNull(), G.wkt_polygon(rings)))
    if "path" in features.columns:
        shapes.append(F.when(F.col("path").isNotNull(), G.wkt_line(F.col("path"))))
    if "x" in features.columns:
        shapes.append(F.when(F.col("x").isNotNull(), G.wkt_point(F.col("x"), F.col("y"))))
    if not shapes:
        raise ValueError("the table has no geometry columns")
    return F.coalesce(*shapes)


def write_wkt(
    features: DataFrame, path: str, mode: str = "errorifexists", position: int = 0, sep: str = ";", header: bool = True
) -> None:
    """CSV with the geometry as WKT at the given output position."""
    attributes = [F.col(c) for c in features.columns if c not in GEOMETRY]
    attributes.insert(position, geometry_wkt(features).alias("geometry"))
    features.select(*attributes).write.mode(mode).csv(path, sep=sep, header=header)


def write_geojson(features: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Line-delimited GeoJSON features; many tasks write in parallel."""
    attributes = [c for c in features.columns if c not in GEOMETRY]

    def positions(points: Column) -> Column:
        return F.transform(points, lambda p: F.array(p["x"], p["y"]))

    def geometry(kind: Column | str, coordinates: Column) -> Column:
        kind = F.lit(kind) if isinstance(kind, str) else kind
        return F.concat(F.lit('{"type":"'), kind, F.lit('","coordinates":'), F.to_json(coordinates), F.lit("}"))

    shapes = []
    if "rings" in features.columns:
        rings = F.transform("rings", positions)
        if "geom_type" in features.columns:
            kind = F.col("geom_type")
            shapes.append(F.when((kind == "LineString") & (F.size(rings) == 1), geometry("LineString", rings[0])))
            shapes.append(F.when(kind.isin("LineString", "MultiLineString"), geometry("MultiLineString", rings)))
            shapes.append(F.when(kind == "MultiPolygon", geometry(kind, F.transform(G.polygons_of(F.col("rings")), lambda p: F.transform(p, positions)))))
        shapes.append(F.when(F.col("rings").isNotNull(), geometry("Polygon", rings)))
    if "path" in features.columns:
        shapes.append(F.when(F.col("path").isNotNull(), geometry("LineString", positions(F.col("path")))))
    if "x" in features.columns:
        shapes.append(F.when(F.col("x").isNotNull(), geometry("Point", F.array("x", "y"))))
    properties = F.to_json(F.struct(*attributes), {"ignoreNullFields": "false"}) if attributes else F.lit("{}")
    line = F.concat(
        F.lit('{"type":"Feature","geometry":'), F.coalesce(*shapes, F.lit("null")),
        F.lit(',"properties":'), properties, F.lit("}"),
    )
    features.select(line.alias("value")).write.mode(mode).text(path)


register_reader("parquet", _read_parquet, ".parquet")
register_reader("csv", _read_points_csv, ".csv")
register_reader("wkt", _read_wkt, ".wkt")
register_reader("geojson", geojson.load_geojson, ".geojson")
register_reader("shapefile", shapefile.load_shapefile, ".shp")
register_reader("shapefile", shapefile.load_shapefile, ".zip")
register_reader("roadnetwork", roads.load_roads)
register_writer("parquet", _write_parquet)
register_writer("csv", write_csv_points)
register_writer("wkt", write_wkt)
register_writer("geojson", write_geojson)
register_writer("shapefile", shapefile.write_shapefile)
