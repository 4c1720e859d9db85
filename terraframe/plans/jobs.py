"""End-to-end jobs, composed of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import et
from ..functions.geometry import Box
from ..functions.ieee import narrow
from ..functions.sizes import row_bytes
from ..grid import Grid
from ..operators import partition, raster, spatial_join, vector, visual
from ..sources import features as io
from ..sources import rasters, tiff


def penman_monteith(stack: DataFrame, precision: str = "double", pressure: str = "p") -> DataFrame:
    """Latent heat flux and its intermediate bands.

    ``stack`` is an overlay with the bands ``t`` (surface K), ``t_a`` (air K), ``u``
    (wind m/s), ``r_sd, r_ld, r_lu`` (W/m2), ``alpha`` and a pressure in Pa. Each band
    is one projection over the row before it, so the whole chain is a narrow stage.
    The pressure band is used as the vapour pressure of the air, and the air
    saturation pressure comes from the surface temperature, as in the workload this
    reproduces; pass another ``pressure`` band to use a true vapour pressure.
    """

    def keep(column):
        return narrow(column, precision)

    c = F.col
    return (
        stack.withColumns(
            {
                "delta": keep(et.svp_slope(c("t"))),
                "e_a": keep(et.pascal_to_kilopascal(c(pressure))),
                "r_n": keep(et.net_radiation(c("r_sd"), c("r_ld"), c("r_lu"), c("alpha"))),
                "r_ah": keep(et.aerodynamic_resistance(c("u"), roughness=0.005, displacement=0.0, height=10.0)),
                "e_o": keep(et.svp(c("t"))),
            }
        )
        .withColumn("h", keep(et.sensible_heat_flux(c("t"), c("t_a"), c("r_ah"))))
        .withColumn("et_inst", keep(et.instantaneous_et(c("t"), c("r_n"), c("h"))))
        .withColumn("r_s", keep(et.bulk_surface_resistance(c("e_o"), c("e_a"), c("et_inst"), c("r_ah"))))
        .withColumn(
            "le", keep(et.latent_heat_flux(c("delta"), c("r_n"), c("e_o"), c("e_a"), c("r_ah"), c("r_s")))
        )
    )


def fao56_scalars(
    temperature: DataFrame, humidity: DataFrame, elevation: float = 10.0,
    kelvin_offset: float = et.KELVIN_OFFSET_RASTER, rh_divisor: float = 2.0, precision: str = "double",
) -> DataFrame:
    """The whole-raster numbers of FAO-56 in one row: vapour pressures, pressure, gamma.

    ``temperature`` has band ``t`` (K) and ``humidity`` band ``rh``. Each raster is read
    once for its minimum and maximum; pass one stack for both and it is one aggregate.
    """

    def keep(column):
        return narrow(column, precision)

    c = F.col
    if humidity is temperature:
        extremes = raster.min_max(temperature, ["t", "rh"])
    else:
        other = raster.min_max(humidity, ["rh"])
        extremes = raster.min_max(temperature, ["t"]).select(
            "*", other.select("rh_min").scalar().alias("rh_min"), other.select("rh_max").scalar().alias("rh_max")
        )
    return (
        extremes.select(
            keep(et.kelvin_to_celsius(c("t_min"), kelvin_offset)).alias("t_min"),
            keep(et.kelvin_to_celsius(c("t_max"), kelvin_offset)).alias("t_max"),
            "rh_min", "rh_max",
            keep(et.pressure_from_elevation(F.lit(elevation))).alias("pressure"),
        )
        .withColumns({"e_min": keep(et.svp_celsius(c("t_min"))), "e_max": keep(et.svp_celsius(c("t_max")))})
        .withColumns(
            {
                "gamma": keep(et.psychrometric_constant(c("pressure"))),
                "e_s": keep(et.mean_svp(c("e_min"), c("e_max"))),
                "e_a": keep(et.actual_vapour_pressure(c("e_min"), c("e_max"), c("rh_min"), c("rh_max"), rh_divisor)),
            }
        )
    )


def fao56_reference_et(
    stack: DataFrame, scalars: DataFrame, wind_height: float = 10.0, precision: str = "double"
) -> DataFrame:
    """FAO-56 reference evapotranspiration per pixel.

    ``stack`` has bands ``t`` (K), ``u``, ``r_s``, ``r_nl``. The scalars come in as a scalar
    subquery: computed once, then constants in the projection; nothing is joined.
    """

    def keep(column):
        return narrow(column, precision)

    c = F.col
    numbers = scalars.select(F.struct("gamma", "e_s", "e_a").alias("s")).scalar()
    return (
        stack.withColumns(
            {
                "delta": keep(et.svp_slope(c("t"))),
                "r_ns": keep(et.net_shortwave(c("r_s"))),
                "u_2": keep(et.wind_at_2m(c("u"), wind_height)),
                "_s": numbers,
            }
        )
        .withColumn("r_n", keep(et.net_radiation_simple(c("r_ns"), c("r_nl"))))
        .withColumn(
            "et_o",
            keep(et.reference_et(c("delta"), c("u_2"), c("t"), c("r_n"), c("_s.gamma"), c("_s.e_s"), c("_s.e_a"))),
        )
        .drop("_s")
    )


def overlay_sum(rasters: list[DataFrame], alias: str = "total") -> DataFrame:
    """Overlay rasters and add their bands up per pixel."""
    stack = raster.overlay(rasters)
    bands = raster.bands_of(stack, raster.PIXEL)
    total = sum((F.col(b) for b in bands[1:]), F.col(bands[0]))
    return stack.withColumn(alias, total)


def geotag_points(polygons: DataFrame, points: DataFrame, box: Box, name: str = "NAME", alias: str = "state") -> DataFrame:
    """Points of a rectangle with the name of the polygon that contains them."""
    near = vector.range_query(points, box)
    joined = spatial_join.spatial_join(vector.range_query(polygons, box), near, "contains")
    return vector.tag_points(joined, near, name, alias)


def point_in_polygon(polygons: DataFrame, points: DataFrame, predicate: str = "intersects") -> DataFrame:
    """Polygon attributes, point attributes and point geometry of all matches."""
    joined = spatial_join.spatial_join(polygons, points, predicate)
    return vector.polygon_then_point(joined, polygons, points)


def run_point_in_polygon(
    spark: SparkSession, polygons: str, points: str, output: str, overwrite: bool = False,
    options: dict[str, str] | None = None,
) -> None:
    """The point-in-polygon operation on files; output is WKT CSV split by ``;``."""
    loaded = []
    for index, path in enumerate((polygons, points)):
        own = io.options_for(options or {}, index)
        loaded.append(io.load_features(spark, path, own.pop("iformat", None), own.pop("filter_mbr", None), **own))
    shapes = loaded[0]
    if "geom_type" in shapes.columns:
        shapes = shapes.where(F.lower("geom_type").like("%polygon")).drop("geom_type", "x", "y")
    spots = loaded[1].drop("geom_type", "rings", *vector.BOX)
    result = point_in_polygon(shapes, spots)
    polygon_attributes = [c for c in shapes.columns if c not in vector.GEOMETRY]
    io.save_features(result, output, "wkt", overwrite, position=len(polygon_attributes))


def index_and_visualize(
    spark: SparkSession, features: DataFrame, index_output: str, plot_output: str, *,
    partitions: int | None = None, max_level: int = 19, overwrite: bool = False, threshold: int = 0,
) -> str:
    """Summarize, index and build the tile pyramid of a feature set; returns the summary JSON.

    Without ``partitions`` their number follows from the size of the features. One aggregate gives the summary, the
    extent and the size; nothing is cached, and the pyramid reads the index instead of the input.
    """
    mode = "overwrite" if overwrite else "errorifexists"
    reduced = vector.reduce_to_2d(features)
    found = vector.summary_json(features, bytes=F.coalesce(F.sum(row_bytes(reduced)), F.lit(0))).first()
    corners = [found[c] for c in vector.BOX]
    bounds = Box(0.0, 0.0, 1.0, 1.0) if None in corners else Box(*corners)
    partitioner = partition.SpatialPartitioner.fit(reduced, partitions, size=int(found["bytes"]))
    partition.write_index(reduced, partitioner, index_output, mode=mode, extent=bounds)
    stored = partition.read_index(spark, index_output)
    tiles = visual.pyramid(stored, 0, max_level, bounds=bounds, threshold=threshold)
    tiles.write.mode(mode).parquet(plot_output)
    return found["json"]


def run_penman_monteith(
    spark: SparkSession, paths: dict[str, str], grid: Grid, output: str, *,
    precision: str = "double", write_mode: str = "distributed", overwrite: bool = False,
) -> None:
    """The Penman-Monteith job on stored rasters.

    ``paths`` maps the bands ``t, t_a, u, r_sd, r_ld, r_lu, alpha, p`` to TIFF files or to
    tile tables in Parquet; the first layer of each is used. Tile tables must be in the layout
    of ``grid``; images are checked against it and cut anew where their tiles differ. One tile
    overlay brings them together; the result is written as tiles.
    """
    layers = []
    for band, path in paths.items():
        image = path.lower().endswith((".tif", ".tiff"))
        tiles = tiff.load_on_grid(spark, path, grid) if image else rasters.read_tiles(spark, path)
        if "band" in tiles.columns:
            tiles = raster.select_band(tiles, 0)
        value = "tile" if "tile" in tiles.columns else band
        layers.append(tiles.select(*raster.TILE, F.col(value).alias(band)))
    stack = raster.overlay_tiles(layers)
    result = raster.compute_tiles(stack, grid, lambda pixels: penman_monteith(pixels, precision), ["le"])
    rasters.write_tiles(result, output, grid, write_mode=write_mode, mode="overwrite" if overwrite else "errorifexists")


def count_in_range(features: DataFrame, box: Box) -> DataFrame:
    """Number of all features and of those in a rectangle, in one scan."""
    return features.agg(
        F.count("*").alias("n_all"), F.count_if(vector.in_range(features, box)).alias("n_in_range")
    )
