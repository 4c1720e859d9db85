"""Rasters and features derived from the benchmark tables.

All of them read whole tables and are plain column arithmetic, so work grows with
the tables and another SQL engine can derive the same inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import Box
from ..grid import Grid
from ..operators import raster

WIDTH = 200
# Tall enough for the keys of any scale; y runs downwards.
GRID = Grid(-180.0, 0.0, 180.0, -2e9, 4326, WIDTH, 2_000_000_000, 10, 10)
COARSE = Grid(-180.0, 0.0, 180.0, -2e9, 4326, 75, 800_000_000, 10, 10)
RANGE = Box(-128.1, 27.3, -63.8, 54.3)


# Columns in use; with a schema given, no job has to read file footers for it.
SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
                "l_discount double, l_tax double",
    "events": "event_id bigint, event_type string, value double",
    "customer": "c_custkey bigint, c_mktsegment string",
    "nation": "n_nationkey int, n_name string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def _pixel(key: str) -> list[str]:
    return [f"cast({key} % {WIDTH} as int) AS x", f"cast({key} div {WIDTH} as int) AS y"]


def surface(spark: SparkSession, folder: str) -> DataFrame:
    """Bands of the orders table: temperatures, albedo, pressure, humidity, elevation."""
    pixels = table(spark, folder, "orders").selectExpr(
        *_pixel("o_orderkey"),
        "273.15D + o_custkey % 40 AS t",
        "273.65D + o_custkey % 40 + o_orderkey % 7 - 3 AS t_a",
        "0.05D + (o_orderkey % 30) / 100D AS alpha",
        "95000D + (o_custkey % 100) * 50 AS p",
        "20D + o_custkey % 60 AS rh",
        "cast(o_custkey % 3000 as double) AS z",
    )
    return raster.rasterize(pixels, GRID, ["t", "t_a", "alpha", "p", "rh", "z"], unique=True)


def land(spark: SparkSession, folder: str) -> DataFrame:
    """Bands of the lineitem table, several lines per pixel: wind and longwave radiation."""
    pixels = table(spark, folder, "lineitem").selectExpr(
        *_pixel("l_orderkey"),
        "0.5D + l_quantity / 10D AS u",
        "250D + l_tax * 1000D AS r_ld",
        "300D + l_discount * 1000D AS r_lu",
        "l_tax * 1000D AS r_nl",
    )
    return raster.rasterize(pixels, GRID, ["u", "r_ld", "r_lu", "r_nl"])


def sky(spark: SparkSession, folder: str) -> DataFrame:
    """Downward shortwave radiation from the events table."""
    pixels = table(spark, folder, "events").selectExpr(*_pixel("event_id"), "100D + value AS r_sd")
    return raster.rasterize(pixels, GRID, ["r_sd"], unique=True)


def layers(spark: SparkSession, folder: str) -> DataFrame:
    """A multi-band raster in long form: band = line number - 1."""
    pixels = table(spark, folder, "lineitem").selectExpr(
        *_pixel("l_orderkey"), "l_linenumber - 1 AS band", "l_quantity AS value"
    )
    return pixels.groupBy("x", "y", "band").agg(F.max("value").alias("value"))


def climate_stack(spark: SparkSession, folder: str) -> DataFrame:
    """All bands of the Penman-Monteith chain on the pixels that every raster has."""
    ours = surface(spark, folder).select("x", "y", "t", "t_a", "alpha", "p")
    theirs = land(spark, folder).select("x", "y", "u", "r_ld", "r_lu")
    return raster.overlay([ours, theirs, sky(spark, folder)])


def _point(key: str, x: str = "x", y: str = "y") -> list[str]:
    return [f"({key} * 7919 % 36000) / 100D - 180D AS {x}", f"({key} * 104729 % 18000) / 100D - 90D AS {y}"]


def points(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").selectExpr("event_id", *_point("event_id"), "event_type", "value")


def _diamond(shapes: DataFrame, dent: bool) -> DataFrame:
    """Replace ``cx, cy, w, h`` by a closed diamond in ``rings``, dented on its right side if wanted."""
    corners = ["(cx + w, cy)", "(cx, cy + h)", "(cx - w, cy)", "(cx, cy - h)", *(["(cx + w / 6D, cy)"] if dent else [])]
    named = [f"named_struct('x', {x}, 'y', {y})" for x, y in (c[1:-1].split(", ") for c in [*corners, corners[0]])]
    kept = [c for c in shapes.columns if c not in ("cx", "cy", "w", "h")]
    return shapes.selectExpr(*kept, f"array(array({', '.join(named)})) AS rings")


def regions(spark: SparkSession, folder: str, dent: bool = False) -> DataFrame:
    """25 large diamonds from the nation table."""
    shapes = table(spark, folder, "nation").selectExpr(
        "n_nationkey AS region_id", "n_name AS NAME",
        "cast(-160 + 80 * (n_nationkey % 5) as double) AS cx",
        "cast(-72 + 36 * (n_nationkey div 5) as double) AS cy", "30D AS w", "15D AS h",
    )
    return _diamond(shapes, dent)


def parcels(spark: SparkSession, folder: str, dent: bool = False) -> DataFrame:
    """Small diamonds of many sizes from the customer table."""
    shapes = table(spark, folder, "customer").selectExpr(
        "c_custkey", "c_mktsegment", *_point("c_custkey", "cx", "cy"),
        "0.2D + (c_custkey % 50) / 10D AS w", "(0.2D + (c_custkey % 50) / 10D) / 2D AS h",
    )
    return _diamond(shapes, dent)


def holed_parcels(spark: SparkSession, folder: str) -> DataFrame:
    """Diamonds of the customer table with a hole each; shells and holes turn either way."""

    def ring(cx: str, w: str, h: str) -> str:
        corners = [(f"{cx} + {w}", "cy"), (cx, f"cy + {h}"), (f"{cx} - {w}", "cy"), (cx, f"cy - {h}")]
        return "array(" + ", ".join(f"named_struct('x', {x}, 'y', {y})" for x, y in [*corners, corners[0]]) + ")"

    shapes = table(spark, folder, "customer").selectExpr(
        "c_custkey", *_point("c_custkey", "cx", "cy"), "0.2D + (c_custkey % 50) / 10D AS w",
        "(0.2D + (c_custkey % 50) / 10D) / 2D AS h",
    )
    shell, hole = ring("cx", "w", "h"), ring("(cx + w / 4D)", "w / 4D", "h / 4D")
    return shapes.selectExpr(
        "c_custkey",
        f"array(if(c_custkey % 3 = 0, reverse({shell}), {shell}), if(c_custkey % 2 = 0, reverse({hole}), {hole})) AS rings",
    )


def road_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Road-format CSV text from the orders table, with a quoted field that has a comma."""
    ends = table(spark, folder, "orders").selectExpr(
        "*", *_point("o_orderkey", "x1", "y1"), *_point("o_custkey", "x2", "y2")
    )
    quoted = "concat('\"', o_orderstatus, ',', o_orderpriority, '\"')"
    return ends.selectExpr(f"concat_ws(',', o_orderkey, {quoted}, x1, y1, o_custkey, x2, y2) AS value")


def border_lines(spark: SparkSession, folder: str, box: Box) -> DataFrame:
    """Lines of the orders table, many of them moved onto sides of a box or around its corner."""
    ends = table(spark, folder, "orders").selectExpr("o_orderkey", *_point("o_orderkey", "x1", "y1"), *_point("o_custkey", "x2", "y2"))
    low = f"least({box.maxy}D, greatest({box.miny}D, y%d))"
    side = f"struct(cast({box.minx} as double) AS x, {low} AS y)"
    corner = f"struct(cast({box.minx} as double) AS x, cast({box.miny} as double) AS y)"
    base = f"struct(least({box.maxx}D, greatest({box.minx}D, x2)) AS x, cast({box.miny} as double) AS y)"
    return ends.selectExpr(
        "o_orderkey",
        f"CASE o_orderkey % 4 WHEN 0 THEN array({side % 1}, {side % 2}) WHEN 1 THEN array({side % 1}, {corner}, {base}) "
        f"WHEN 2 THEN array({side % 1}, {base}) ELSE array(struct(x1 AS x, y1 AS y), struct(x2 AS x, y2 AS y)) END AS path",
    )


def granules(spark: SparkSession, folder: str) -> DataFrame:
    """A manifest of one-degree granules from the orders table."""
    return table(spark, folder, "orders").selectExpr(
        "concat('g', o_orderkey) AS name", *_point("o_orderkey", "minx", "miny"),
        "to_date(o_orderdate) AS date", "o_orderstatus AS status",
    ).selectExpr("name", "minx", "miny", "minx + 1 AS maxx", "miny + 1 AS maxy", "date", "status")
