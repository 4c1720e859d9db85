"""Band-interleaved-by-line rasters with a text header."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..grid import Grid
from .ranges import RANGE_BYTES, list_files, open_file, pixels_of, plan_files, read_exactly, read_ranges, total_length, write_blocks

PIXELS = "x int, y int, band int, value double"
PLAN = "path string, first long, last long, columns int, bands int, shift int"
WORDS = ("NROWS", "NCOLS", "NBANDS", "NBITS", "NODATA")


@dataclass(frozen=True)
class BilHeader:
    rows: int
    columns: int
    bands: int = 1
    bits: int = 32
    nodata: int | None = None


def read_header(spark: SparkSession, path: str) -> BilHeader:
    """Parse the ``.hdr`` file (a few lines, read on the driver)."""
    return parse_header("\n".join(line[0] for line in spark.read.text(path).collect()), path)


def parse_header(text: str, path: str) -> BilHeader:
    tokens = text.split()
    found: dict[str, int] = {}
    for word, value in zip(tokens, [*tokens[1:], ""]):
        if word in WORDS:
            if not re.fullmatch(r"-?\d+(\.\d*)?", value):
                raise ValueError(f"expected a number after {word} in {path}, got {value!r}")
            found[word] = int(float(value))
    missing = {"NROWS", "NCOLS"} - found.keys()
    if missing:
        raise ValueError(f"{path} lacks {sorted(missing)}")
    header = BilHeader(
        found["NROWS"], found["NCOLS"], found.get("NBANDS", 1), found.get("NBITS", 32), found.get("NODATA")
    )
    if header.bits > 32:
        raise ValueError(f"{path} has {header.bits} bits per pixel; at most 32 are supported")
    return header


def _check(header: BilHeader, path: str, stored: int, itemsize: int) -> int:
    """Bytes of one line of one band; the data must be as long as the header says."""
    line = header.columns * itemsize
    if stored < line * header.rows * header.bands:
        raise ValueError(f"{path} has {stored} bytes; its header wants {line * header.rows * header.bands}")
    return line


def _read(dtype: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Pixels of planned runs of lines, one batch a line."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = np.dtype(dtype).itemsize
        for batch in batches:
            for plan in batch.to_pylist():
                width, bands = plan["columns"], plan["bands"]
                x = pa.array(np.arange(width, dtype="int32"))
                with open_file(plan["path"]) as file:
                    for line in range(plan["first"], plan["last"]):
                        raw = read_exactly(file, width * size, line * width * size)
                        place = [np.full(width, n, "int32") for n in (line // bands + plan["shift"], line % bands)]
                        value = np.frombuffer(raw, dtype).astype("float64")
                        yield pa.RecordBatch.from_arrays(
                            [x, *[pa.array(p) for p in place], pa.array(value)], ["x", "y", "band", "value"]
                        )

    return read


def load_bil(
    spark: SparkSession, root: str, dtype: str = ">i4", nodata: float | None = None, range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """Pixels ``(x, y, band, value)`` of ``root.hdr`` + ``root.bil``.

    Runs of image lines are read by their place in the file, so a file of any size is the work of
    many tasks and is read once. ``dtype`` is big-endian int32 unless told otherwise; pixels
    equal to ``nodata`` (by default kept, as stored) are left out.
    """
    header = read_header(spark, f"{root}.hdr")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}.bil")
    status = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path)
    line = _check(header, f"{root}.bil", status.getLen(), np.dtype(dtype).itemsize)
    many, total = max(1, range_bytes // line), header.rows * header.bands
    tasks = -(-total // many)
    planned = spark.range(0, total, many, tasks).select(
        F.lit(status.getPath().toString()).alias("path"), F.col("id").alias("first"),
        F.least(F.col("id") + many, F.lit(total)).alias("last"), F.lit(header.columns).alias("columns"),
        F.lit(header.bands).alias("bands"), F.lit(0).alias("shift"),
    )
    pixels = planned.mapInArrow(_read(dtype), PIXELS)
    return pixels if nodata is None else pixels.where(F.col("value") != nodata)


def load_bil_folder(
    spark: SparkSession, folder: str, grid: Grid, dtype: str = ">i4", nodata: float | None = None, range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """Pixels ``(x, y, band, value)`` of a raster stored as many files side by side, as :func:`write_bil` leaves it.

    Each header's ``ULYMAP`` (the middle of its first line on the map) places the file in ``grid``.
    """
    def plan(path: str) -> Iterator[dict]:
        with open_file(path) as file:
            text = file.read().decode("ascii")
        header, data = parse_header(text, path), path.removesuffix(".hdr") + ".bil"
        with open_file(data) as file:
            line = _check(header, data, file.size(), np.dtype(dtype).itemsize)
        found = re.search(r"\bULYMAP\s+(\S+)", text)
        shift = 0 if found is None else round((float(found[1]) - grid.y1) / grid.step_y - 0.5)
        many, total = max(1, range_bytes // line), header.rows * header.bands
        for first in range(0, total, many):
            last = min(first + many, total)
            yield {"path": data, "first": first, "last": last, "columns": header.columns, "bands": header.bands, "shift": shift}

    planned = plan_files(list_files(spark, folder, "*.hdr"), plan, PLAN)
    stored = total_length(list_files(spark, folder, "*.bil"))
    pixels = read_ranges(planned, -(-stored // range_bytes), _read(dtype), PIXELS, ("path", "first"))
    return pixels if nodata is None else pixels.where(F.col("value") != nodata)


def write_bil(
    tiles: DataFrame, path: str, grid: Grid, bands: Sequence[str], dtype: str = ">i4", nodata: float = -9999, overwrite: bool = False
) -> None:
    """Write bands of a tile table as ``.bil`` + ``.hdr`` files, one pair for each row of tiles, by many tasks.

    Values are rounded to ``dtype``; one that it cannot hold, or that equals ``nodata``, is an error.
    """
    kind, bands = np.dtype(dtype), list(bands)
    width = grid.width

    def encode(key: tuple, rows: list) -> dict[str, bytes]:
        top = key[0] * grid.tile_height
        lines = min(grid.tile_height, grid.height - top)
        image = np.full((grid.tile_height, len(bands), grid.tiles_across * grid.tile_width), np.nan)
        for batch, row in rows:
            left = batch.column("tx")[row].as_py() * grid.tile_width
            for i, band in enumerate(bands):
                if batch.column(band)[row].is_valid:
                    tile = pixels_of(batch, band, row).reshape(grid.tile_height, grid.tile_width)
                    image[:, i, left : left + grid.tile_width] = tile
        image = image[:lines, :, :width]
        empty = np.isnan(image)
        stored = np.where(empty, nodata, image if kind.kind == "f" else np.round(image)).astype("float64")
        if (stored[~empty] == nodata).any():
            raise ValueError(f"a value would be stored as the nodata value {nodata}")
        if kind.kind != "f" and ((stored < np.iinfo(kind).min) | (stored > np.iinfo(kind).max)).any():
            raise ValueError(f"a value does not fit {dtype}")
        words = {
            "BYTEORDER": "M" if kind.str[0] == ">" else "I", "LAYOUT": "BIL", "NROWS": lines, "NCOLS": width,
            "NBANDS": len(bands), "NBITS": kind.itemsize * 8, "NODATA": nodata,
            "ULXMAP": repr(grid.x1 + grid.step_x / 2), "ULYMAP": repr(grid.y1 + (top + 0.5) * grid.step_y),
            "XDIM": repr(abs(grid.step_x)), "YDIM": repr(abs(grid.step_y)),
        }
        return {".bil": stored.astype(kind).tobytes(), ".hdr": "".join(f"{k} {v}\n" for k, v in words.items()).encode()}

    inside = F.col("tx").between(0, grid.tiles_across - 1) & F.col("ty").between(0, grid.tiles_down - 1)
    write_blocks(tiles.where(inside).select("ty", "tx", *bands), path, "bil_blocks", ["ty"], ["tx"], encode, overwrite)
