"""The registered queries: one per operator or job, on the benchmark tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import et
from ..functions import geometry as G
from ..functions.geometry import Box
from ..functions.ieee import divide
from ..operators import granules, partition, raster, spatial_join, vector, visual
from ..session import shared_folder
from ..sources import bil, features, geojson, rasters, roads, tiff
from . import jobs, testbed

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _rounded(frame: DataFrame, **digits: int) -> DataFrame:
    return frame.withColumns({name: F.round(name, d) for name, d in digits.items()})


# Rasters


@query
def raster_load(spark, folder):
    return testbed.surface(spark, folder).select("x", "y", "t", "t_a", "p")


@query
def rasterize(spark, folder):
    return _rounded(testbed.land(spark, folder), u=6, r_ld=6, r_lu=6, r_nl=6)


@query
def grid_coords(spark, folder):
    located = raster.with_coordinates(testbed.surface(spark, folder).select("x", "y"), testbed.GRID)
    return _rounded(located, centre_x=6, centre_y=6)


@query
def map_pixels(spark, folder):
    stack = testbed.surface(spark, folder).select("x", "y", "t", "p")
    mapped = raster.map_pixels(
        stack, t=lambda t: et.kelvin_to_celsius(t, et.KELVIN_OFFSET_RASTER), p=et.pascal_to_kilopascal
    )
    return _rounded(mapped, t=6, p=6)


@query
def band_select(spark, folder):
    return raster.select_band(testbed.layers(spark, folder), 0)


@query
def flatten(spark, folder):
    stack = testbed.surface(spark, folder).select("x", "y", "t", "p")
    return raster.flatten(raster.to_tiles(stack, testbed.GRID), testbed.GRID)


@query
def raster_store(spark, folder):
    """A raster written as tiles by many tasks, read again and unpacked."""
    path = shared_folder(spark, "raster")
    tiles = raster.to_tiles(testbed.surface(spark, folder).select("x", "y", "t", "p"), testbed.GRID)
    rasters.write_tiles(tiles, path, testbed.GRID)
    return raster.flatten(rasters.read_tiles(spark, path), testbed.GRID)


@query
def raster_tiff(spark, folder):
    """Bands written as TIFF images by many tasks, one packed to 8 bits, and read again by byte range."""
    grid, path = replace(testbed.GRID, tile_width=16, tile_height=16), shared_folder(spark, "images")
    tiles = raster.to_tiles(testbed.surface(spark, folder).select("x", "y", "t", "p"), grid)
    tiff.write_tiff(tiles, f"{path}/t", grid, ["t"], "u1", nodata=255, shift=273.15)
    tiff.write_tiff(tiles, f"{path}/p", grid, ["p"], "f4")
    bands = [tiff.load_mosaic(spark, f"{path}/{b}", grid).withColumnRenamed("tile", b) for b in ("t", "p")]
    return _rounded(raster.flatten(raster.overlay_tiles(bands), grid), t=6, p=6)


@query
def bil_load(spark, folder):
    """Bands written as band-interleaved lines and read again by byte range."""
    path = shared_folder(spark, "lines")
    tiles = raster.to_tiles(testbed.surface(spark, folder).select("x", "y", "p", "z"), testbed.GRID)
    bil.write_bil(tiles, path, testbed.GRID, ["p", "z"])
    return bil.load_bil_folder(spark, path, testbed.GRID, nodata=-9999)


@query
def overlay_stored(spark, folder):
    """Rasters stored in buckets of tiles and overlaid where they lie."""
    grid, name = testbed.GRID, f"tiles_{uuid.uuid4().hex}"
    inputs = {
        "t": testbed.surface(spark, folder).select("x", "y", "t"), "u": testbed.land(spark, folder).select("x", "y", "u"),
        "r_sd": testbed.sky(spark, folder),
    }
    for band, pixels in inputs.items():
        rasters.write_tile_table(raster.to_tiles(pixels, grid), f"{name}_{band}", spark.sparkContext.defaultParallelism)
    stack = raster.overlay_tiles([spark.table(f"{name}_{band}") for band in inputs])
    stack = raster.flatten(stack, grid, [*inputs], complete=True)
    return _rounded(stack.withColumn("total", F.col("t") + F.col("u") + F.col("r_sd")), t=6, u=6, r_sd=6, total=6)


@query
def raster_minmax(spark, folder):
    found = raster.min_max(testbed.surface(spark, folder), ["t", "rh"])
    return _rounded(found, t_min=6, t_max=6, rh_min=6, rh_max=6)


@query
def tile_count(spark, folder):
    return raster.tile_count(testbed.land(spark, folder), testbed.GRID)


@query
def pixel_lookup(spark, folder):
    return raster.pixel_at(testbed.surface(spark, folder), 1, 4).select("x", "y", "t", "t_a", "p")


@query
def overlay_3way(spark, folder):
    total = jobs.overlay_sum(
        [
            testbed.surface(spark, folder).select("x", "y", "t"),
            testbed.land(spark, folder).select("x", "y", "u"),
            testbed.sky(spark, folder),
        ]
    )
    return _rounded(total, t=6, u=6, r_sd=6, total=6)


@query
def overlay_outer(spark, folder):
    stack = raster.overlay(
        [testbed.surface(spark, folder).select("x", "y", "t"), testbed.land(spark, folder).select("x", "y", "u"),
         testbed.sky(spark, folder)],
        how="outer",
    )
    return _rounded(stack, t=6, u=6, r_sd=6)


@query
def overlay_tiles(spark, folder):
    grid = testbed.GRID
    tiles = [
        raster.to_tiles(testbed.surface(spark, folder).select("x", "y", "t"), grid),
        raster.to_tiles(testbed.land(spark, folder).select("x", "y", "u"), grid),
        raster.to_tiles(testbed.sky(spark, folder), grid),
    ]
    stack = raster.flatten(raster.overlay_tiles(tiles), grid, ["t", "u", "r_sd"], complete=True)
    return _rounded(stack.withColumn("total", F.col("t") + F.col("u") + F.col("r_sd")), t=6, u=6, r_sd=6, total=6)


@query
def tile_algebra(spark, folder):
    """The Penman-Monteith chain from tiles to tiles, unpacked at the end."""
    grid = testbed.GRID
    surface = testbed.surface(spark, folder).select("x", "y", "t", "t_a", "alpha", "p")
    land = testbed.land(spark, folder).select("x", "y", "u", "r_ld", "r_lu")
    stack = raster.overlay_tiles([raster.to_tiles(r, grid) for r in (surface, land, testbed.sky(spark, folder))])
    tiles = raster.compute_tiles(stack, grid, jobs.penman_monteith, ["delta", "le"])
    return _rounded(raster.flatten(tiles, grid), delta=6, le=10)


@query
def overlay_nested(spark, folder):
    """Overlay of (slope, wind) with (temperature, net radiation), themselves overlays."""
    surface = testbed.surface(spark, folder).select("x", "y", "t")
    land = testbed.land(spark, folder).select("x", "y", "u", "r_nl")
    first = raster.overlay(
        [surface.select("x", "y", et.svp_slope(F.col("t")).alias("delta")),
         land.select("x", "y", et.wind_at_2m(F.col("u")).alias("u_2"))]
    )
    radiation = raster.overlay([testbed.sky(spark, folder), land.select("x", "y", "r_nl")]).select(
        "x", "y", et.net_radiation_simple(et.net_shortwave(F.col("r_sd")), F.col("r_nl")).alias("r_n")
    )
    second = raster.overlay([surface, radiation])
    return _rounded(raster.overlay([first, second]), delta=6, u_2=6, t=6, r_n=6)


@query
def reshape_nn(spark, folder):
    stack = testbed.surface(spark, folder).select("x", "y", "t", "p")
    return raster.reshape_nearest(stack, testbed.GRID, testbed.COARSE)


# Equations


@query
def svp_slope(spark, folder):
    stack = testbed.surface(spark, folder)
    return stack.select("x", "y", F.round(et.svp_slope(F.col("t")), 6).alias("delta"))


@query
def svp(spark, folder):
    return testbed.surface(spark, folder).select("x", "y", F.round(et.svp(F.col("t")), 6).alias("e_o"))


@query
def aero_resistance(spark, folder):
    resistance = et.aerodynamic_resistance(F.col("u"), 0.005, 0.0, 10.0)
    return testbed.land(spark, folder).select("x", "y", F.round(resistance, 6).alias("r_ah"))


@query
def wind_2m(spark, folder):
    return testbed.land(spark, folder).select("x", "y", F.round(et.wind_at_2m(F.col("u"), 10.0), 6).alias("u_2"))


@query
def atm_pressure(spark, folder):
    pressure = et.pressure_from_elevation(F.col("z"))
    return testbed.surface(spark, folder).select(
        "x", "y", F.round(pressure, 6).alias("pressure"),
        F.round(et.psychrometric_constant(pressure), 8).alias("gamma"),
    )


def _chain(spark: SparkSession, folder: str, *columns: Column | str) -> DataFrame:
    return jobs.penman_monteith(testbed.climate_stack(spark, folder)).select("x", "y", *columns)


@query
def net_radiation(spark, folder):
    return _chain(spark, folder, F.round("r_n", 6).alias("r_n"))


@query
def sensible_heat(spark, folder):
    return _chain(spark, folder, F.round("h", 6).alias("h"))


@query
def instant_et(spark, folder):
    heat = et.latent_heat_of_vaporization(F.col("t"))
    return _chain(spark, folder, F.round(heat, 3).alias("vaporization"), F.round("et_inst", 10).alias("et_inst"))


@query
def surface_resistance(spark, folder):
    # The resistance itself reaches 1e15; its inverse can be compared digit by digit.
    # Adding zero turns a negative zero into a plain one.
    return _chain(spark, folder, (F.round(divide(1e6, F.col("r_s")), 8) + F.lit(0.0)).alias("inverse_r_s"))


@query
def et_penman_monteith(spark, folder):
    return _chain(
        spark, folder,
        *[F.round(c, d).alias(c) for c, d in (("delta", 6), ("r_n", 6), ("r_ah", 6), ("h", 6), ("e_o", 6),
                                              ("et_inst", 10), ("le", 10))],
    )


@query
def fao56_scalars(spark, folder):
    stack = testbed.surface(spark, folder)
    scalars = jobs.fao56_scalars(stack, stack)
    return _rounded(scalars, t_min=6, t_max=6, rh_min=6, rh_max=6, pressure=6, e_min=6, e_max=6, gamma=8, e_s=6, e_a=6)


@query
def fao56_et0(spark, folder):
    surface = testbed.surface(spark, folder)
    stack = raster.overlay(
        [
            surface.select("x", "y", "t"),
            testbed.land(spark, folder).select("x", "y", "u", "r_nl"),
            testbed.sky(spark, folder).withColumnRenamed("r_sd", "r_s"),
        ]
    )
    result = jobs.fao56_reference_et(stack, jobs.fao56_scalars(surface, surface))
    return _rounded(result.select("x", "y", "delta", "r_n", "u_2", "et_o"), delta=6, r_n=6, u_2=6, et_o=6)


# Features


@query
def feature_load(spark, folder):
    return _rounded(testbed.points(spark, folder), x=6, y=6)


@query
def range_query(spark, folder):
    return _rounded(vector.range_query(testbed.points(spark, folder), testbed.RANGE), x=6, y=6)


@query
def range_contains(spark, folder):
    # A box whose border runs through points, unlike the range query above.
    box = Box(-128.0, 27.0, -64.0, 54.0)
    return _rounded(vector.range_query(testbed.points(spark, folder), box, "contains"), x=6, y=6)


@query
def range_query_count(spark, folder):
    return jobs.count_in_range(testbed.points(spark, folder), testbed.RANGE)


@query
def range_pushdown(spark, folder):
    """A rectangle on stored coordinate columns: the comparisons reach the Parquet scan."""
    stored = testbed.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("x"), F.col("l_quantity").alias("y")
    )
    return vector.range_query(stored, Box(20000.0, 10.0, 45000.0, 30.0))


@query
def range_polygons(spark, folder):
    return vector.range_query(testbed.parcels(spark, folder), testbed.RANGE).select("c_custkey", "c_mktsegment")


# A convex quadrilateral, counter-clockwise.
QUAD = [(-100.0, -40.0), (60.0, -70.0), (120.0, 30.0), (-20.0, 80.0), (-100.0, -40.0)]


@query
def range_polygon(spark, folder):
    """Points strictly inside one given polygon."""
    return _rounded(vector.within_polygon(testbed.points(spark, folder), [QUAD]), x=6, y=6)


@query
def pip_intersects(spark, folder):
    joined = spatial_join.spatial_join(
        testbed.regions(spark, folder), testbed.points(spark, folder).select("event_id", "x", "y"), "intersects"
    )
    return joined.select("region_id", "event_id")


@query
def pip_contains(spark, folder):
    joined = spatial_join.spatial_join(
        testbed.regions(spark, folder), testbed.points(spark, folder).select("event_id", "x", "y"), "contains",
        algorithm="pbsm",
    )
    return joined.select("region_id", "event_id")


@query
def pip_concave(spark, folder):
    joined = spatial_join.spatial_join(
        testbed.regions(spark, folder, dent=True), testbed.points(spark, folder).select("event_id", "x", "y"),
        "intersects",
    )
    return joined.select("region_id", "event_id")


@query
def pip_parcels(spark, folder):
    """Many polygons of very different sizes; both sides are shuffled by cell."""
    joined = spatial_join.spatial_join(
        testbed.parcels(spark, folder), testbed.points(spark, folder).select("event_id", "x", "y"), "contains",
        algorithm="pbsm",
    )
    return joined.select("c_custkey", "event_id")


@query
def pip_attributes(spark, folder):
    result = jobs.point_in_polygon(testbed.regions(spark, folder), testbed.points(spark, folder))
    return _rounded(result, x=6, y=6)


@query
def geotag_points(spark, folder):
    result = jobs.geotag_points(testbed.regions(spark, folder), testbed.points(spark, folder), testbed.RANGE)
    return _rounded(result, x=6, y=6)


@query
def wkt_points(spark, folder):
    found = testbed.points(spark, folder)
    x, y = F.round("x", 2), F.round("y", 2)
    return found.select("event_id", G.wkt_point(x, y).alias("geometry"), "event_type")


@query
def wkt_polygons(spark, folder):
    """Polygons as WKT text, parsed back by the reader's expressions."""
    text = testbed.parcels(spark, folder).select("c_custkey", G.wkt_polygon(F.col("rings")).alias("wkt"))
    parsed = text.select("c_custkey", G.rings_from_wkt(F.col("wkt")).alias("rings"))
    boxed = vector.with_envelope(parsed).select("c_custkey", *vector.BOX)
    return _rounded(boxed, minx=6, miny=6, maxx=6, maxy=6)


@query
def csv_points(spark, folder):
    """Tagged points written as CSV by many tasks and loaded again by format name."""
    tagged = jobs.geotag_points(testbed.regions(spark, folder), testbed.points(spark, folder), testbed.RANGE)
    path = shared_folder(spark, "points")
    features.save_features(tagged, path, "csv")
    schema = "x double, y double, event_id bigint, event_type string, value double, state string"
    return _rounded(features.load_features(spark, path, "csv", schema=schema), x=6, y=6)


@query
def envelope_join(spark, folder):
    shapes = vector.with_envelope(testbed.parcels(spark, folder)).drop("rings", "c_mktsegment")
    sheets = testbed.granules(spark, folder).select(
        "name", *[F.col(c).alias(f"g_{c}") for c in vector.BOX]
    )
    pairs = spatial_join.envelope_join(
        sheets, shapes, left_box=[f"g_{c}" for c in vector.BOX], algorithm="pbsm"
    )
    return pairs.select("name", "c_custkey")


@query
def geojson_features(spark, folder):
    """Points as GeoJSON text, parsed back by the reader."""
    found = testbed.points(spark, folder)
    text = F.concat(
        F.lit('{"type":"Feature","geometry":{"type":"Point","coordinates":'), F.to_json(F.array("x", "y")),
        F.lit('},"properties":'), F.to_json(F.struct("event_id", "event_type")), F.lit("}"),
    )
    parsed = geojson.parse_geojson(found.select(text.alias("value")), "event_id bigint, event_type string")
    return _rounded(parsed.select("event_id", "event_type", "geom_type", "x", "y"), x=6, y=6)


def _roads(spark: SparkSession, folder: str) -> DataFrame:
    return roads.parse_roads(testbed.road_lines(spark, folder))


@query
def road_segments(spark, folder):
    attribute = [F.get("attrs", F.lit(i)) for i in range(3)]
    return _roads(spark, folder).select(
        attribute[0].cast("bigint").alias("o_orderkey"), attribute[1].alias("label"),
        attribute[2].cast("bigint").alias("o_custkey"),
        *[F.round(c, 6).alias(c) for c in ("x1", "y1", "x2", "y2")],
        F.round(G.path_length(F.col("path")), 6).alias("length"),
    )


@query
def line_centroid(spark, folder):
    centre = G.line_centroid(F.col("path"))
    return _roads(spark, folder).select(
        F.get("attrs", F.lit(0)).cast("bigint").alias("o_orderkey"),
        F.round(centre["x"], 6).alias("x"), F.round(centre["y"], 6).alias("y"),
    )


@query
def road_summary(spark, folder):
    summary = vector.summarize(_roads(spark, folder).select("attrs", "path"))
    return _rounded(summary, minx=6, miny=6, maxx=6, maxy=6, avg_width=6, avg_height=6)


@query
def feature_summary(spark, folder):
    summary = vector.summarize(testbed.parcels(spark, folder))
    return _rounded(summary, minx=6, miny=6, maxx=6, maxy=6, avg_width=6, avg_height=6)


@query
def polygon_mbr(spark, folder):
    boxed = vector.with_envelope(testbed.parcels(spark, folder)).select("c_custkey", *vector.BOX)
    return _rounded(boxed, minx=6, miny=6, maxx=6, maxy=6)


@query
def polygon_centroid(spark, folder):
    centre = G.polygon_centroid(F.col("rings"))
    return testbed.parcels(spark, folder, dent=True).select(
        "c_custkey", F.round(centre["x"], 6).alias("x"), F.round(centre["y"], 6).alias("y")
    )


@query
def polygon_centroid_holes(spark, folder):
    """Polygons with holes from WKT and from GeoJSON text; their rings turn either way."""
    shapes = testbed.holed_parcels(spark, folder)
    as_wkt = F.col("c_custkey") % 4 < 2
    wkt = shapes.where(as_wkt).select("c_custkey", G.rings_from_wkt(G.wkt_polygon(F.col("rings"))).alias("rings"))
    positions = F.transform("rings", lambda r: F.transform(r, lambda p: F.array(p["x"], p["y"])))
    text = F.concat(
        F.lit('{"type":"Feature","geometry":{"type":"Polygon","coordinates":'), F.to_json(positions),
        F.lit('},"properties":'), F.to_json(F.struct("c_custkey")), F.lit("}"),
    )
    json = geojson.parse_geojson(shapes.where(~as_wkt).select(text.alias("value")), "c_custkey bigint")
    centre = G.polygon_centroid(F.col("rings"))
    return wkt.unionByName(json.select("c_custkey", "rings")).select(
        "c_custkey", F.round(centre["x"], 6).alias("x"), F.round(centre["y"], 6).alias("y")
    )


@query
def range_contains_boxes(spark, folder):
    """Boxes in a rectangle of which some touch the border from inside."""
    return vector.range_query(testbed.granules(spark, folder), Box(-128.0, 27.0, -64.0, 54.0), "contains").select("name")


@query
def range_contains_lines(spark, folder):
    """Lines in a rectangle, many of them on its border or around its corner, where they are not inside."""
    box = Box(-128.0, 27.0, -64.0, 54.0)
    return vector.range_query(testbed.border_lines(spark, folder, box), box, "contains").select("o_orderkey")


@query
def drop_to_2d(spark, folder):
    """Points with three ordinates and boxes with three dimensions, reduced to two."""
    spots = testbed.points(spark, folder).select(F.array("x", "y", "value").alias("at"))
    flat = vector.with_envelope(vector.reduce_to_2d(spots, point="at")).select(F.lit("point").alias("kind"), *vector.BOX)
    sheets = testbed.granules(spark, folder).select(
        F.array("minx", "miny", F.lit(0.0)).alias("low"), F.array("maxx", "maxy", F.lit(1.0)).alias("high")
    )
    boxes = vector.reduce_to_2d(sheets, low="low", high="high").select(F.lit("box").alias("kind"), *vector.BOX)
    return _rounded(flat.unionByName(boxes), minx=6, miny=6, maxx=6, maxy=6)


# Joins and range queries of lines and polygons


@query
def join_parcels_regions(spark, folder):
    """Polygons that share a point with polygons."""
    parcels = testbed.parcels(spark, folder).withColumnRenamed("rings", "shape").select("c_custkey", "shape")
    pairs = spatial_join.shape_join(testbed.regions(spark, folder), parcels, right_shape="shape", tol=1e-9, algorithm="pbsm")
    return pairs.select("region_id", "c_custkey")


@query
def join_regions_contain(spark, folder):
    """Polygons wholly inside polygons, a common border allowed."""
    parcels = testbed.parcels(spark, folder).withColumnRenamed("rings", "shape").select("c_custkey", "shape")
    pairs = spatial_join.shape_join(testbed.regions(spark, folder), parcels, "contains", right_shape="shape", tol=1e-9)
    return pairs.select("region_id", "c_custkey")


@query
def join_roads_regions(spark, folder):
    """Lines that share a point with polygons; the parsed lines are stored, since the join reads them several times."""
    path = shared_folder(spark, "roads")
    parsed = _roads(spark, folder).select(F.get("attrs", F.lit(0)).cast("bigint").alias("o_orderkey"), "path")
    features.save_features(parsed, path, "parquet")
    lines = features.load_features(spark, path, "parquet")
    pairs = spatial_join.shape_join(testbed.regions(spark, folder), lines, tol=1e-9, algorithm="pbsm")
    return pairs.select("region_id", "o_orderkey")


# A diamond with the proportions of the parcels.
DIAMOND = [(90.0, 0.0), (0.0, 45.0), (-90.0, 0.0), (0.0, -45.0), (90.0, 0.0)]


@query
def range_polygon_shapes(spark, folder):
    """Polygons that meet one given polygon, and those that lie in it."""
    shapes = testbed.parcels(spark, folder)
    found = [
        vector.within_polygon(shapes, [DIAMOND], predicate, tol=1e-9).select("c_custkey", F.lit(predicate).alias("predicate"))
        for predicate in ("intersects", "contains")
    ]
    return found[0].unionByName(found[1])


# Stores


@query
def wkt_store(spark, folder):
    """Polygons written as WKT by many tasks and loaded again by format name."""
    path = shared_folder(spark, "wkt")
    features.save_features(testbed.parcels(spark, folder).withColumnRenamed("c_mktsegment", "segment"), path, "wkt")
    stored = features.load_features(spark, path, "wkt").select(F.col("c_custkey").cast("bigint"), *vector.BOX)
    return _rounded(stored, minx=6, miny=6, maxx=6, maxy=6)


@query
def convert_formats(spark, folder):
    """Points stored as Parquet, converted to GeoJSON and loaded from there."""
    source, target = shared_folder(spark, "points"), shared_folder(spark, "converted")
    features.save_features(testbed.points(spark, folder).select("event_id", "event_type", "x", "y"), source, "parquet")
    features.convert(spark, source, target, "parquet", "geojson")
    stored = features.load_features(spark, target, "geojson", properties="event_id bigint, event_type string")
    return _rounded(stored.select("event_id", "event_type", "geom_type", "x", "y"), x=6, y=6)


@query
def shapefile_load(spark, folder):
    """Outlines written as shapefiles by many tasks; a range query reaches the reader."""
    path = shared_folder(spark, "shapes")
    features.save_features(testbed.parcels(spark, folder).withColumnRenamed("c_mktsegment", "segment"), path, "shapefile")
    found = features.load_features(spark, path, "shapefile", testbed.RANGE, attributes=["c_custkey"])
    return _rounded(found.select(F.col("c_custkey").cast("long"), *vector.BOX), minx=6, miny=6, maxx=6, maxy=6)


@query
def overwrite_store(spark, folder):
    """A stored feature set replaced by another one."""
    path, found = shared_folder(spark, "points"), testbed.points(spark, folder)
    features.save_features(found.withColumn("value", F.lit(0.0)), path, "parquet")
    features.save_features(found, path, "parquet", overwrite=True)
    return _rounded(features.load_features(spark, path, "parquet"), x=6, y=6)


@query
def summary_json(spark, folder):
    """The summary as JSON text, parsed again."""
    shapes = testbed.parcels(spark, folder)
    kind = vector.summarize(shapes).schema.simpleString()
    parsed = F.from_json("json", f"struct<summary:{kind}>", {"mode": "FAILFAST"})
    summary = vector.summary_json(shapes).select(parsed["summary"].alias("s")).select("s.*")
    return _rounded(summary, minx=6, miny=6, maxx=6, maxy=6, avg_width=6, avg_height=6)


@query
def index_pyramid(spark, folder):
    """The index-and-visualize job from features to the stored pyramid."""
    index, plot = shared_folder(spark, "index"), shared_folder(spark, "pyramid")
    jobs.index_and_visualize(spark, testbed.points(spark, folder), index, plot)
    return spark.read.parquet(plot)


# Partitioning and index


@query
def spatial_partition(spark, folder):
    found = testbed.points(spark, folder)
    partitioner = partition.SpatialPartitioner.fit(found, 16)
    return partition.partition_summary(partitioner.assign(found))


@query
def spatial_partition_check(spark, folder):
    """Completeness, balance by bytes and disjointness of the partitions."""
    found = testbed.points(spark, folder)
    assigned = partition.SpatialPartitioner.fit(found, 16).assign(found)
    path = shared_folder(spark, "parts")
    partition.partition_summary(assigned).write.parquet(path)
    parts = spark.read.parquet(path)
    once = assigned.groupBy("event_id").agg(F.count("*").alias("n")).agg(F.count_if(F.col("n") == 1)).scalar()
    return parts.agg(
        F.sum("n_features").alias("n_features"), F.count("*").alias("n_parts"),
        (F.max("n_bytes") <= F.avg("n_bytes") * 1.2).alias("balanced"),
        F.round(F.min("minx"), 6).alias("minx"), F.round(F.max("maxx"), 6).alias("maxx"),
        F.round(F.min("miny"), 6).alias("miny"), F.round(F.max("maxy"), 6).alias("maxy"),
    ).select(
        "*", partition.overlapping_parts(parts).agg(F.count("*")).scalar().alias("n_overlaps"), once.alias("n_seen_once")
    )


@query
def indexed_range(spark, folder):
    found = testbed.points(spark, folder)
    path = shared_folder(spark, "index")
    partition.write_index(found, partition.SpatialPartitioner.fit(found, 16), path)
    hits = partition.read_index(spark, path, testbed.RANGE)
    return _rounded(hits.select("event_id", "x", "y"), x=6, y=6)


# Visual aggregates


@query
def pyramid_counts(spark, folder):
    return visual.pyramid(testbed.points(spark, folder), 0, 19)


@query
def pyramid_clusters(spark, folder):
    """Clusters on every tile of nine levels, merged from level to level."""
    shapes = vector.with_envelope(testbed.parcels(spark, folder))
    return visual.plot_pyramid(shapes, visual.ClusterPyramid(), 0, 8)


@query
def cluster_cells(spark, folder):
    canvas = visual.Canvas(Box(-180.0, -90.0, 180.0, 90.0), 1000, 500)
    return visual.cluster_plot(testbed.points(spark, folder), canvas, radius=50)


# Granules

WANTED = ("-125.530,30.751,-112.742,43.213", "1995.01.01..1997.12.31")


@query
def granule_select(spark, folder):
    return granules.select_granules(testbed.granules(spark, folder), *WANTED).select("name", "date")


@query
def granule_missing(spark, folder):
    """Granules of a wider region that were not fetched yet (fetched ones have status F)."""
    manifest = testbed.granules(spark, folder)
    wanted = granules.select_granules(manifest, "-125.530,-30.751,12.742,43.213", "1995.01.01..2000.12.31")
    present = manifest.where(F.col("status") == "F")
    return granules.missing_granules(wanted, present).select("name", "date")
