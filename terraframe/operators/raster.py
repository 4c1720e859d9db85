"""Raster operators.

Two layouts of the same data:

* pixel table ``(x, y, <band>, ...)``: one row per non-empty pixel, the query view;
* tile table ``(tx, ty, <band>, ...)``: one row per tile, each band a row-major
  ``array<double>`` with NULL for empty pixels, the storage and overlay view.

A raster with several bands keeps them as named columns, so that an overlay of
overlays needs no positions. No operator here collects data or crosses pixels.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..grid import Grid, floor_div

PIXEL = ("x", "y")
TILE = ("tx", "ty")


def bands_of(raster: DataFrame, keys: Sequence[str]) -> list[str]:
    return [name for name in raster.columns if name not in keys]


def rasterize(
    pixels: DataFrame,
    grid: Grid,
    bands: Sequence[str] = ("value",),
    agg: Callable[[Column], Column] = F.max,
    unique: bool = False,
) -> DataFrame:
    """Put ``(x, y, band...)`` rows on a grid; rows outside it are not part of the raster.

    Rows of one pixel are merged by ``agg`` (partial aggregates run before the
    shuffle, so a pixel with very many rows is harmless). Pass ``unique=True``
    when ``(x, y)`` is known to be a key: then nothing is shuffled at all.
    """
    kept = pixels.select(*PIXEL, *bands).where(grid.inside(F.col("x"), F.col("y")))
    if not unique:
        kept = kept.groupBy(*PIXEL).agg(*[agg(F.col(b)).alias(b) for b in bands])
    return kept.where(reduce(Column.__or__, [F.col(b).isNotNull() for b in bands]))


def with_coordinates(raster: DataFrame, grid: Grid) -> DataFrame:
    """Add pixel-centre coordinates, tile keys and the offset within the tile."""
    x, y = F.col("x"), F.col("y")
    return raster.withColumns(
        {
            "centre_x": grid.centre_x(x),
            "centre_y": grid.centre_y(y),
            "tx": grid.tile_x(x),
            "ty": grid.tile_y(y),
            "tile_offset": grid.offset(x, y),
        }
    )


def to_tiles(raster: DataFrame, grid: Grid, bands: Sequence[str] | None = None) -> DataFrame:
    """Pack pixels into dense tile arrays.

    Pixels must be unique (as from :func:`rasterize`), so a group holds at most
    ``grid.tile_pixels`` rows whatever the data look like; two pixels at one place raise an
    error. Pixels outside the grid are not part of the raster.
    """
    bands = list(bands or bands_of(raster, PIXEL))
    x, y = F.col("x"), F.col("y")
    entries = raster.where(grid.inside(x, y)).select(
        grid.tile_x(x).alias("tx"),
        grid.tile_y(y).alias("ty"),
        F.struct(grid.offset(x, y).alias("at"), *bands).alias("entry"),
    )
    return _pack(entries, grid, bands)


def _pack(entries: DataFrame, grid: Grid, bands: Sequence[str]) -> DataFrame:
    packed = entries.groupBy(*TILE).agg(F.sort_array(F.collect_list("entry")).alias("entries"))
    return packed.select(*TILE, *[_dense(F.col("entries"), b, grid.tile_pixels).alias(b) for b in bands])


def _dense(entries: Column, band: str, length: int) -> Column:
    """Array of ``length`` values from entries sorted by offset, NULL in the gaps.

    Each entry is preceded by as many NULLs as positions were skipped, which is
    linear in the tile size; looking every position up would be quadratic.
    """
    before = F.concat(F.array(F.lit(-1)), F.transform(entries, lambda e: e["at"]))
    runs = F.zip_with(
        entries,
        F.slice(before, 1, F.size(entries)),
        lambda e, prev: F.when(
            e["at"] > prev,
            F.concat(
                F.array_repeat(F.lit(None).cast("double"), e["at"] - prev - 1),
                F.array(e[band].cast("double")),
            ),
        ).otherwise(F.raise_error(F.lit("two pixels at one place of a tile; merge them by rasterize")).cast("array<double>")),
    )
    rest = F.lit(length - 1) - F.element_at(before, -1)
    return F.concat(F.flatten(runs), F.array_repeat(F.lit(None).cast("double"), rest))


def _cells(tiles: DataFrame, bands: Sequence[str], complete: bool) -> DataFrame:
    """One row ``(tx, ty, at, bands...)`` per non-empty pixel of a tile table."""
    # A tile missing from one raster zips like an empty array: padded with NULL.
    arrays = [F.coalesce(F.col(b), F.array().cast("array<double>")).alias(b) for b in bands]
    rows = tiles.select(*TILE, *arrays).select(*TILE, F.posexplode(F.arrays_zip(*bands)).alias("at", "cell"))
    needed = Column.__and__ if complete else Column.__or__
    return rows.select(*TILE, "at", *[F.col("cell").getField(b).alias(b) for b in bands]).where(
        reduce(needed, [F.col(b).isNotNull() for b in bands])
    )


def flatten(
    tiles: DataFrame, grid: Grid, bands: Sequence[str] | None = None, complete: bool = False
) -> DataFrame:
    """Unpack tiles to pixel rows; pixels empty in every band are dropped.

    With ``complete`` a pixel needs all bands, the pixel form of an inner overlay.
    """
    bands = list(bands or bands_of(tiles, TILE))
    return _cells(tiles, bands, complete).select(
        (F.col("tx") * grid.tile_width + F.col("at") % grid.tile_width).alias("x"),
        (F.col("ty") * grid.tile_height + floor_div(F.col("at"), grid.tile_width)).alias("y"),
        *bands,
    )


def compute_tiles(
    tiles: DataFrame,
    grid: Grid,
    transform: Callable[[DataFrame], DataFrame],
    bands: Sequence[str],
    complete: bool = True,
) -> DataFrame:
    """Map algebra from tiles to tiles.

    ``transform`` gets one row per pixel and adds ``bands``; it must keep the columns
    ``tx, ty, at``. Tiles that come out of an overlay are already placed by their key,
    so unpacking, computing and packing again happens where they lie.
    """
    computed = transform(_cells(tiles, bands_of(tiles, TILE), complete))
    return _pack(computed.select(*TILE, F.struct("at", *bands).alias("entry")), grid, bands)


def overlay(rasters: Sequence[DataFrame], how: str = "inner") -> DataFrame:
    """Bring the bands of several rasters on one grid together, per pixel."""
    return _stack(rasters, PIXEL, how)


def overlay_tiles(rasters: Sequence[DataFrame], how: str = "inner") -> DataFrame:
    """Bring tiles of the same position together; rows stay whole tiles.

    Rasters stored bucketed by tile (``sources.rasters.write_tiles``) meet here
    without any shuffle.
    """
    return _stack(rasters, TILE, how)


def _stack(rasters: Sequence[DataFrame], keys: Sequence[str], how: str) -> DataFrame:
    if len(rasters) < 2:
        raise ValueError("an overlay needs at least two rasters")
    names = [b for r in rasters for b in bands_of(r, keys)]
    if len(set(names)) != len(names):
        raise ValueError(f"band names must differ between the overlaid rasters: {names}")
    if how == "inner":
        # A raster file grows a lot when decoded, so its size on disk must not
        # make Spark broadcast it; a sort-merge join also spills when needed.
        return reduce(lambda left, right: left.join(right.hint("merge"), list(keys)), rasters)
    if how == "outer":
        # One shuffle for all inputs. Every cell occurs once per raster, so max
        # only picks the value that is there.
        together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rasters)
        return together.groupBy(*keys).agg(*[F.max(n).alias(n) for n in names])
    raise ValueError(f"how must be 'inner' or 'outer', not {how!r}")


def band_array(raster: DataFrame, names: Sequence[str], alias: str = "bands") -> DataFrame:
    """The overlay as one array per pixel, in the order given."""
    return raster.select(*PIXEL, F.array(*names).alias(alias))


def map_pixels(raster: DataFrame, **bands: Column | Callable[[Column], Column]) -> DataFrame:
    """Compute bands from bands. A callable is applied to the band of the same name."""
    return raster.withColumns(
        {n: (e if isinstance(e, Column) else e(F.col(n))) for n, e in bands.items()}
    )


def map_tiles(tiles: DataFrame, func: Callable, bands: Sequence[str] | None = None) -> DataFrame:
    """Escape hatch: apply a NumPy function to the array of every tile.

    Empty pixels arrive as NaN and NaN results become empty. Prefer
    :func:`map_pixels`, which stays in the JVM.
    """
    @F.pandas_udf("array<double>")
    def apply(column: pd.Series) -> pd.Series:
        return column.map(lambda tile: func(np.asarray(tile, dtype="float64")))

    def cleaned(name: str) -> Column:
        mapped = apply(F.col(name))
        return F.transform(mapped, lambda v: F.when(F.isnan(v), None).otherwise(v)).alias(name)

    bands = list(bands or bands_of(tiles, TILE))
    return tiles.select(*TILE, *[cleaned(b) for b in bands])


def select_band(raster: DataFrame, band: int = 0) -> DataFrame:
    """One band of a raster in long form ``(x, y, band, value)``."""
    return raster.where(F.col("band") == band).drop("band")


def min_max(raster: DataFrame, bands: Sequence[str] | None = None) -> DataFrame:
    """Minimum and maximum of every band, in one pass."""
    bands = list(bands or bands_of(raster, PIXEL))
    return raster.agg(
        *[f(b).alias(f"{b}_{n}") for b in bands for n, f in (("min", F.min), ("max", F.max))]
    )


def tile_count(raster: DataFrame, grid: Grid) -> DataFrame:
    """Number of non-empty tiles of a pixel raster."""
    tiles = raster.select(grid.tile_x(F.col("x")).alias("tx"), grid.tile_y(F.col("y")).alias("ty"))
    return tiles.distinct().agg(F.count("*").alias("n_tiles"))


def pixel_at(raster: DataFrame, x: int, y: int) -> DataFrame:
    return raster.where((F.col("x") == x) & (F.col("y") == y))


def tile_pixel_at(tiles: DataFrame, grid: Grid, x: int, y: int) -> DataFrame:
    """One pixel of a tile table; the tile key is a plain filter that reaches the scan."""
    at = (y % grid.tile_height) * grid.tile_width + x % grid.tile_width
    hit = tiles.where((F.col("tx") == x // grid.tile_width) & (F.col("ty") == y // grid.tile_height))
    return hit.select(
        F.lit(x).alias("x"), F.lit(y).alias("y"),
        *[F.get(F.col(b), F.lit(at)).alias(b) for b in bands_of(tiles, TILE)],
    )


def reshape_nearest(raster: DataFrame, source: Grid, target: Grid) -> DataFrame:
    """Nearest-neighbour copy of a raster onto another grid with the same CRS.

    A target pixel takes the source pixel that holds its centre. Turned round, a
    source pixel fills a run of columns and a run of rows, so each row is exploded
    into its target pixels where it lies: no join, no shuffle, no target grid to
    generate. Candidates get one pixel of slack, then the exact rule decides.
    """
    if source.srid != target.srid:
        raise ValueError("reshaping does not reproject; both grids need the same srid")

    def run(index: Column, s0: float, s_step: float, t0: float, t_step: float, length: int) -> Column:
        first = (F.lit(s0) + index * F.lit(s_step) - F.lit(t0)) / F.lit(t_step)
        last = (F.lit(s0) + (index + 1) * F.lit(s_step) - F.lit(t0)) / F.lit(t_step)
        low = F.greatest(F.floor(F.least(first, last)) - 1, F.lit(0))
        high = F.least(F.ceil(F.greatest(first, last)) + 1, F.lit(length - 1))
        some = F.when(low <= high, F.sequence(low.cast("int"), high.cast("int")))
        return F.filter(
            some,
            lambda t: F.floor(
                (F.lit(t0) + (t + F.lit(0.5)) * F.lit(t_step) - F.lit(s0)) / F.lit(s_step)
            ) == index,
        )

    bands = bands_of(raster, PIXEL)
    columns = raster.where(source.inside(F.col("x"), F.col("y"))).select(
        F.col("y").alias("_sy"),
        F.explode(
            run(F.col("x"), source.x1, source.step_x, target.x1, target.step_x, target.width)
        ).alias("x"),
        *bands,
    )
    if math.fabs(source.step_x / target.step_x) > 256:
        # Strong magnification: spread the columns of one source pixel over tasks
        # before its rows are exploded too.
        columns = columns.repartition("x", "_sy")
    return columns.select(
        "x",
        F.explode(
            run(F.col("_sy"), source.y1, source.step_y, target.y1, target.step_y, target.height)
        ).alias("y"),
        *bands,
    )
