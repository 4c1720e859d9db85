"""Raster storage: tile tables in Parquet or in bucketed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..grid import Grid
from ..operators.raster import TILE


def write_tiles(
    tiles: DataFrame, path: str, grid: Grid, *, write_mode: str = "distributed", mode: str = "errorifexists"
) -> None:
    """Store a tile table.

    ``distributed`` lets every task write its tiles as they lie. ``compatibility`` orders them
    by tile row and column over all files: a raster that fits one task becomes a single
    file, a larger one a run of files, each written by its own task.
    """
    if write_mode == "compatibility":
        tiles = tiles.repartitionByRange("ty", "tx").sortWithinPartitions("ty", "tx")
    elif write_mode != "distributed":
        raise ValueError(f"write_mode must be 'distributed' or 'compatibility', not {write_mode!r}")
    tiles.write.mode(mode).parquet(path)


def write_tile_table(tiles: DataFrame, table: str, buckets: int, mode: str = "errorifexists") -> None:
    """Store a tile table bucketed by tile key.

    Rasters of one grid with the same bucket count are overlaid without a shuffle.
    """
    placed = tiles.repartition(buckets, *TILE)
    placed.write.mode(mode).bucketBy(buckets, *TILE).sortBy(*TILE).saveAsTable(table)


def read_tiles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
