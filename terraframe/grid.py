"""Raster grids as column arithmetic."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def floor_div(value: Column, by: int) -> Column:
    """Whole-number quotient of a non-negative integer column."""
    return F.floor(value / F.lit(by)).cast("int")


@dataclass(frozen=True)
class Grid:
    """A regular pixel grid cut into tiles.

    ``(x1, y1)`` is the outer corner of pixel (0, 0) and ``(x2, y2)`` the opposite
    corner, so ``x2 < x1`` or ``y2 < y1`` gives a negative step.
    """

    x1: float
    y1: float
    x2: float
    y2: float
    srid: int
    width: int
    height: int
    tile_width: int = 256
    tile_height: int = 256

    def __post_init__(self) -> None:
        if min(self.width, self.height, self.tile_width, self.tile_height) <= 0:
            raise ValueError("grid and tile sizes must be positive")
        if self.x1 == self.x2 or self.y1 == self.y2:
            raise ValueError("a grid needs two different corners")

    @property
    def step_x(self) -> float:
        return (self.x2 - self.x1) / self.width

    @property
    def step_y(self) -> float:
        return (self.y2 - self.y1) / self.height

    @property
    def tiles_across(self) -> int:
        return -(-self.width // self.tile_width)

    @property
    def tiles_down(self) -> int:
        return -(-self.height // self.tile_height)

    @property
    def tile_pixels(self) -> int:
        return self.tile_width * self.tile_height

    def inside(self, x: Column, y: Column) -> Column:
        return (x >= 0) & (x < self.width) & (y >= 0) & (y < self.height)

    def centre_x(self, x: Column) -> Column:
        return F.lit(self.x1) + (x + F.lit(0.5)) * F.lit(self.step_x)

    def centre_y(self, y: Column) -> Column:
        return F.lit(self.y1) + (y + F.lit(0.5)) * F.lit(self.step_y)

    def tile_x(self, x: Column) -> Column:
        return floor_div(x, self.tile_width)

    def tile_y(self, y: Column) -> Column:
        return floor_div(y, self.tile_height)

    def offset(self, x: Column, y: Column) -> Column:
        """Position of a pixel inside the array of its tile (row-major)."""
        return (y % self.tile_height) * self.tile_width + (x % self.tile_width)
