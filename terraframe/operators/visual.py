"""Visual analytics as aggregates: map pyramids and cluster plots.

A plotter is an aggregate: Catalyst builds partial canvases map-side and merges
them after the shuffle. Drawing pixels is left to whoever reads the result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import Box
from .vector import with_envelope


# Levels of a pyramid rolled up between two shuffles; a task's group has at most 4 ** 7 tiles.
LEVELS_AT_ONCE = 8


def data_bounds(features: DataFrame) -> Box | None:
    """Bounding box of a feature set (one row reaches the driver)."""
    boxed = features if "minx" in features.columns else with_envelope(features)
    row = boxed.agg(F.min("minx"), F.min("miny"), F.max("maxx"), F.max("maxy")).first()
    return None if row[0] is None else Box(*row)


@dataclass(frozen=True)
class PyramidPlotter:
    """What is drawn on every tile of a pyramid, as state that merges from level to level.

    A tile has ``2 ** detail`` cells along a side. ``state`` gives for each column the aggregate over the features of a
    cell on the deepest level (of any of their columns, boxes included) and the aggregate that merges four
    cells into one. ``finish`` turns ``z, tx, ty, cell_x, cell_y`` and the state into what is drawn; ``side`` is the length
    of the square in map units.
    """

    detail: int = 0
    state: dict[str, tuple[Column, Callable[[Column], Column]]] = field(default_factory=dict)

    def finish(self, cells: DataFrame, side: float) -> DataFrame:
        return cells


class ClusterPyramid(PyramidPlotter):
    """Clusters of ``tile_size >> detail`` pixels on tiles of ``tile_size`` pixels.

    Rows give the count of a cluster and its size ``w, h`` in pixels of the level: that of its largest feature, but at
    least one cell.
    """

    def __init__(self, detail: int = 2, tile_size: int = 256) -> None:
        if tile_size <= 0 or tile_size % (1 << detail):
            raise ValueError("the pixels of a tile must divide into its cells")
        super().__init__(
            detail,
            {
                "count": (F.count("*"), F.sum),
                "_w": (F.max(F.col("maxx") - F.col("minx")), F.max),
                "_h": (F.max(F.col("maxy") - F.col("miny")), F.max),
            },
        )
        object.__setattr__(self, "tile_size", tile_size)

    def finish(self, cells: DataFrame, side: float) -> DataFrame:
        least = F.lit(self.tile_size >> self.detail)

        def pixels(size: str) -> Column:
            return F.greatest(least, F.ceil(F.col(size) / F.lit(side) * F.lit(float(self.tile_size)) * F.pow(F.lit(2.0), "z")).cast("int"))

        return cells.select("z", "tx", "ty", "cell_x", "cell_y", pixels("_w").alias("w"), pixels("_h").alias("h"), "count")


def pyramid(
    features: DataFrame,
    min_level: int = 0,
    max_level: int = 19,
    bounds: Box | None = None,
    threshold: int = 0,
) -> DataFrame:
    """Feature counts of the tiles ``(z, tx, ty)`` of levels ``min_level..max_level``.

    Placed as by :func:`plot_pyramid`. Tiles with a count not above ``threshold`` are left out.
    """
    counts = PyramidPlotter(0, {"n_features": (F.count("*"), F.sum)})
    counted = plot_pyramid(features, counts, min_level, max_level, bounds).drop("cell_x", "cell_y")
    return counted if threshold <= 0 else counted.where(F.col("n_features") > threshold)


def plot_pyramid(
    features: DataFrame, plotter: PyramidPlotter, min_level: int = 0, max_level: int = 19, bounds: Box | None = None
) -> DataFrame:
    """Run a plotter over the tiles ``(z, tx, ty)`` of levels ``min_level..max_level``.

    Tiles are cut from the square over the data (or over ``bounds``); features
    are placed by the centre of their box, and the far edge belongs to the last tile.
    Features are aggregated once on the deepest level; some levels at a time are then rolled up
    in place below a common ancestor, and the level above goes on from there.
    """
    if not 0 <= min_level <= max_level <= max_level + plotter.detail <= 30:
        raise ValueError("levels must satisfy 0 <= min_level <= max_level <= 30, the cells of a tile included")
    boxed = features if "minx" in features.columns else with_envelope(features)
    bounds = bounds or data_bounds(boxed) or Box(0.0, 0.0, 1.0, 1.0)
    side = max(bounds.maxx - bounds.minx, bounds.maxy - bounds.miny) or 1.0
    cells = 1 << (max_level + plotter.detail)

    def index(value: Column, low: float) -> Column:
        at = F.floor((value - F.lit(low)) / F.lit(side) * F.lit(float(cells)))
        return F.least(at, F.lit(cells - 1)).cast("int")

    centre_x = (F.col("minx") + F.col("maxx")) / 2
    centre_y = (F.col("miny") + F.col("maxy")) / 2
    inside = centre_x.between(bounds.minx, bounds.minx + side) & centre_y.between(bounds.miny, bounds.miny + side)
    merges = {n: merge for n, (_, merge) in plotter.state.items()}
    state = (
        boxed.where(inside)
        .groupBy(index(centre_x, bounds.minx).alias("tx"), index(centre_y, bounds.miny).alias("ty"))
        .agg(*[made.alias(n) for n, (made, _) in plotter.state.items()])
    )
    plotted, top = None, max_level
    while True:
        low = max(min_level, top - LEVELS_AT_ONCE + 1)
        levels = _roll_up(state, merges, low, top)
        plotted = levels if plotted is None else plotted.unionByName(levels)
        if low == min_level:
            break
        state = levels.where(F.col("z") == low).select(
            F.shiftright("tx", 1).alias("tx"), F.shiftright("ty", 1).alias("ty"), *merges
        )
        top = low - 1
    last = (1 << plotter.detail) - 1
    placed = plotted.select(
        "z", F.shiftright("tx", plotter.detail).alias("tx"), F.shiftright("ty", plotter.detail).alias("ty"),
        F.col("tx").bitwiseAND(last).alias("cell_x"), F.col("ty").bitwiseAND(last).alias("cell_y"), *merges,
    )
    return plotter.finish(placed, side)


def _roll_up(state: DataFrame, merges: dict[str, Callable[[Column], Column]], low: int, top: int) -> DataFrame:
    """Levels ``low..top`` of a table of the cells of level ``top``.

    Cells are placed by their ancestor on level ``low``, which has at most ``4 ** (top - low)`` of them, so the state of all
    levels is merged where the cells are.
    """
    home = [F.shiftright(c, top - low).alias(f"_{c}") for c in ("tx", "ty")]
    placed = state.select("tx", "ty", *merges, *home).repartition("_tx", "_ty")
    ancestors = F.array(*[
        F.struct(
            F.lit(z).alias("z"), F.shiftright("tx", top - z).alias("tx"), F.shiftright("ty", top - z).alias("ty")
        )
        for z in range(low, top + 1)
    ])
    rows = placed.select("_tx", "_ty", *merges, F.explode(ancestors).alias("t"))
    merged = rows.select("_tx", "_ty", "t.*", *merges).groupBy("_tx", "_ty", "z", "tx", "ty").agg(
        *[merge(F.col(n)).alias(n) for n, merge in merges.items()]
    )
    return merged.drop("_tx", "_ty")


@dataclass(frozen=True)
class Canvas:
    """An image of ``width`` x ``height`` pixels over a map box."""

    bounds: Box
    width: int = 256
    height: int = 256

    def pixel_x(self, x: Column) -> Column:
        span = (self.bounds.maxx - self.bounds.minx) or 1.0
        return F.floor((x - F.lit(self.bounds.minx)) * F.lit(self.width / span)).cast("int")

    def pixel_y(self, y: Column) -> Column:
        span = (self.bounds.maxy - self.bounds.miny) or 1.0
        return F.floor((y - F.lit(self.bounds.miny)) * F.lit(self.height / span)).cast("int")


@dataclass(frozen=True)
class Plotter:
    """A plotter as an aggregate; subclass it or fill in the four parts.

    ``prepare`` adds pixel columns, ``keys`` name the canvas cell, ``aggregates`` are
    the mergeable state, ``finish`` turns the state into what is drawn.
    """

    keys: tuple[str, ...] = ()
    aggregates: dict[str, Column] = field(default_factory=dict)

    def prepare(self, features: DataFrame, canvas: Canvas) -> DataFrame:
        return features

    def finish(self, state: DataFrame, canvas: Canvas) -> DataFrame:
        return state


def plot(features: DataFrame, plotter: Plotter, canvas: Canvas) -> DataFrame:
    """Run a plotter over one image."""
    prepared = plotter.prepare(features, canvas)
    state = prepared.groupBy(*plotter.keys).agg(*[c.alias(n) for n, c in plotter.aggregates.items()])
    return plotter.finish(state, canvas)


class ClusterPlotter(Plotter):
    """Counts features in clusters of ``radius`` pixels.

    A feature's pixel box, widened to at least ``radius``, joins the cluster of the
    ``radius`` cell that holds its centre. Cells do not depend on the order of the
    rows, so partial results merge by adding. Rows give the cluster box on the
    canvas ``(x, y, w, h)`` and its ``count`` label.
    """

    def __init__(self, radius: int = 50) -> None:
        if radius <= 0:
            raise ValueError("radius must be positive")
        super().__init__(
            keys=("cell_x", "cell_y"),
            aggregates={
                "count": F.count("*"),
                "w": F.greatest(F.lit(radius), F.max(F.col("_right") - F.col("_left"))),
                "h": F.greatest(F.lit(radius), F.max(F.col("_top") - F.col("_bottom"))),
            },
        )
        object.__setattr__(self, "radius", radius)

    def prepare(self, features: DataFrame, canvas: Canvas) -> DataFrame:
        boxed = features if "minx" in features.columns else with_envelope(features)
        pixels = boxed.where(F.col("minx").isNotNull() & F.col("miny").isNotNull()).select(
            canvas.pixel_x(F.col("minx")).alias("_left"), canvas.pixel_x(F.col("maxx")).alias("_right"),
            canvas.pixel_y(F.col("miny")).alias("_bottom"), canvas.pixel_y(F.col("maxy")).alias("_top"),
        )

        def cell(low: str, high: str) -> Column:
            return F.floor((F.col(low) + F.col(high)) / F.lit(2 * self.radius)).cast("int")

        return pixels.withColumns({"cell_x": cell("_left", "_right"), "cell_y": cell("_bottom", "_top")})

    def finish(self, state: DataFrame, canvas: Canvas) -> DataFrame:
        def placed(cell: str, size: str, limit: int) -> Column:
            # Centred on its cell, then moved inside the canvas (the far edge wins).
            corner = F.col(cell) * self.radius - F.floor((F.col(size) - self.radius) / 2)
            corner = F.greatest(corner, F.lit(0))
            return F.when(corner + F.col(size) > limit, limit - F.col(size)).otherwise(corner).cast("int")

        return state.select(
            "cell_x", "cell_y",
            placed("cell_x", "w", canvas.width).alias("x"),
            placed("cell_y", "h", canvas.height).alias("y"),
            F.col("w").cast("int").alias("w"), F.col("h").cast("int").alias("h"), "count",
        )


def cluster_plot(features: DataFrame, canvas: Canvas, radius: int = 50) -> DataFrame:
    return plot(features, ClusterPlotter(radius), canvas)
