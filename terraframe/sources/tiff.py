"""Uncompressed TIFF images as tile rows, read by byte range and written in blocks.

The directory of an image is read once, by the task that plans its ranges; its tiles are then read
by as many tasks as their bytes ask for. Classic and 64-bit files are read. Compressed images are
not decoded.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator, Sequence
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..grid import Grid
from ..operators import raster
from .ranges import (
    RANGE_BYTES, doubles, list_files, open_file, pixels_of, plan_files, read_exactly, read_ranges, total_length, write_blocks,
)

SCHEMA = (
    "path string, width int, height int, tile_width int, tile_height int, "
    "band int, tx int, ty int, origin_x double, origin_y double, tile array<double>"
)
# What a task needs to read a run of tiles: the layout of the image and where its blocks lie.
PLAN = (
    "path string, width int, height int, tile_width int, tile_height int, samples int, full boolean, dtype string, "
    "nodata double, scales array<double>, shifts array<double>, origin_x double, origin_y double, "
    "first long, offsets array<long>, sizes array<long>"
)

# Tag numbers and field types of the TIFF 6.0 and GeoTIFF specifications.
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC = 256, 257, 258, 259, 262
STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP, STRIP_BYTES, PLANAR = 273, 277, 278, 279, 284
TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_BYTES = 322, 323, 324, 325
EXTRA_SAMPLES, SAMPLE_FORMAT, PIXEL_SCALE, TIE_POINT, TRANSFORMATION, GEO_KEYS = 338, 339, 33550, 33922, 34264, 34735
METADATA, NODATA = 42112, 42113
FIELD_TYPES = {1: "B", 2: "s", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q", 17: "q"}
KINDS = {1: "u", 2: "i", 3: "f"}


def _tags(file: pa.NativeFile) -> tuple[str, dict[int, tuple]]:
    """Byte order and tags of the first image of a file."""
    head = file.read_at(16, 0)
    order = {b"II": "<", b"MM": ">"}.get(head[:2])
    version = struct.unpack_from(order + "H", head, 2)[0] if order else 0
    if version == 42:
        counter, pointer, start = "H", "I", struct.unpack_from(order + "I", head, 4)[0]
    elif version == 43:
        counter, pointer, start = "Q", "Q", struct.unpack_from(order + "Q", head, 8)[0]
    else:
        raise ValueError("not a TIFF file")
    entry = struct.Struct(f"{order}HH{pointer}")
    room = struct.calcsize(pointer)
    step = entry.size + room
    many = struct.unpack(order + counter, read_exactly(file, struct.calcsize(counter), start))[0]
    directory = read_exactly(file, many * step, start + struct.calcsize(counter))
    tags: dict[int, tuple] = {}
    for i in range(many):
        tag, kind, count = entry.unpack_from(directory, i * step)
        code = FIELD_TYPES.get(kind)
        if code is None:
            continue
        layout = f"{order}{count}{code}"
        size = struct.calcsize(layout)
        held = directory[i * step + entry.size : (i + 1) * step]
        if size > room:
            held = read_exactly(file, size, struct.unpack(order + pointer, held)[0])
        tags[tag] = struct.unpack_from(layout, held)
    return order, tags


def _packing(tags: dict[int, tuple], samples: int) -> tuple[list[float], list[float]]:
    """Scale and offset of each band, from the metadata text."""
    text = tags[METADATA][0].decode("utf-8", "replace") if METADATA in tags else ""
    found = {"scale": [1.0] * samples, "offset": [0.0] * samples}
    for item, value in re.findall(r"<Item([^>]*)>([^<]*)</Item>", text):
        words = dict(re.findall(r'(\w+)="([^"]*)"', item))
        if words.get("role") in found and int(words.get("sample", 0)) < samples:
            found[words["role"]][int(words.get("sample", 0))] = float(value)
    return found["scale"], found["offset"]


def _origin(tags: dict[int, tuple]) -> tuple[float | None, float | None]:
    """Map position of the outer corner of pixel (0, 0)."""
    if TRANSFORMATION in tags:
        return tags[TRANSFORMATION][3], tags[TRANSFORMATION][7]
    if TIE_POINT in tags and PIXEL_SCALE in tags:
        (i, j, _, x, y, _), (sx, sy, _) = tags[TIE_POINT][:6], tags[PIXEL_SCALE]
        return x - i * sx, y + j * sy
    return None, None


def _strip_cut(rows: int, strips: int, limit: int) -> int:
    """Rows of the pieces into which strips are cut: at most ``limit``, and strips hold whole pieces."""
    if rows <= limit or strips == 1:
        return min(rows, limit)
    return next(n for n in range(limit, 0, -1) if rows % n == 0)


def _plan_file(path: str, range_bytes: int = RANGE_BYTES) -> Iterator[dict]:
    with open_file(path) as file:
        order, tags = _tags(file)

    def one(tag: int, default: int) -> int:
        return int(tags.get(tag, (default,))[0])

    if one(COMPRESSION, 1) != 1:
        raise ValueError(f"{path}: only uncompressed images are supported")
    width, height, bands = one(WIDTH, 0), one(HEIGHT, 0), one(SAMPLES, 1)
    dtype = np.dtype(f"{order}{KINDS[one(SAMPLE_FORMAT, 1)]}{one(BITS, 8) // 8}")
    samples = 1 if one(PLANAR, 1) == 2 else bands
    full = TILE_OFFSETS in tags
    offsets = np.array(tags[TILE_OFFSETS if full else STRIP_OFFSETS], "int64")
    if full:
        tile_w, tile_h = one(TILE_WIDTH, width), one(TILE_HEIGHT, height)
        block = tile_w * tile_h * samples * dtype.itemsize
        sizes = np.array(tags.get(TILE_BYTES, [block] * len(offsets)), "int64")
    else:
        # Strips are runs of whole lines, so long ones can be read piece by piece.
        line, strip = width * samples * dtype.itemsize, min(one(ROWS_PER_STRIP, height), height)
        strips = -(-height // strip)
        tile_w, tile_h = width, _strip_cut(strip, strips, max(1, range_bytes // line))
        block = tile_h * line
        pieces, lengths = [], []
        for index, offset in enumerate(offsets.tolist()):
            lines = min(strip, height - index % strips * strip)
            firsts = range(0, lines, tile_h)
            pieces += [offset + at * line for at in firsts]
            lengths += [min(tile_h, lines - at) * line for at in firsts]
        offsets, sizes = np.array(pieces, "int64"), np.array(lengths, "int64")
    nodata = float(tags[NODATA][0].split(b"\0")[0]) if NODATA in tags else None
    scales, shifts = _packing(tags, bands)
    origin_x, origin_y = _origin(tags)
    many = max(1, range_bytes // block)
    for first in range(0, len(offsets), many):
        yield {
            "path": path, "width": width, "height": height, "tile_width": tile_w, "tile_height": tile_h,
            "samples": samples, "full": full, "dtype": dtype.str, "nodata": nodata, "scales": scales, "shifts": shifts,
            "origin_x": origin_x, "origin_y": origin_y,
            "first": first, "offsets": offsets[first : first + many].tolist(), "sizes": sizes[first : first + many].tolist(),
        }


def _tiles(plan: dict, unpack: bool) -> Iterator[tuple[int, int, int, pa.Array]]:
    """``band, tx, ty`` and values of a run of tiles; a block of no bytes is a tile without pixels."""
    width, height, tile_w, tile_h, samples = (plan[n] for n in ("width", "height", "tile_width", "tile_height", "samples"))
    dtype = np.dtype(plan["dtype"])
    across, down = -(-width // tile_w), -(-height // tile_h)
    with open_file(plan["path"]) as file:
        for index, (offset, size) in enumerate(zip(plan["offsets"], plan["sizes"]), plan["first"]):
            if size == 0:
                continue
            plane, position = divmod(index, across * down)
            ty, tx = divmod(position, across)
            h, w = min(tile_h, height - ty * tile_h), min(tile_w, width - tx * tile_w)
            rows = tile_h if plan["full"] else h
            raw = read_exactly(file, rows * tile_w * samples * dtype.itemsize, offset)
            block = np.frombuffer(raw, dtype).reshape(rows, tile_w, samples)
            for sample in range(samples):
                tile = np.full((tile_h, tile_w), np.nan)
                tile[:h, :w] = block[:h, :w, sample]
                empty = np.isnan(tile)
                if plan["nodata"] is not None:
                    empty |= tile == plan["nodata"]
                band = plane if samples == 1 else sample
                if unpack:
                    tile = tile * plan["scales"][band] + plan["shifts"][band]
                yield band, tx, ty, doubles(tile, empty)


def load_tiff(spark: SparkSession, path: str, unpack: bool = True, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Tile rows of all images under ``path``, in the tile (or strip) layout of each file.

    ``origin_x, origin_y`` are the map position of an image's first corner, null where it states none. Tiles without
    a stored block are left out. Values are unpacked by the scale and offset of the image, unless ``unpack`` is false.
    """
    files = list_files(spark, path)
    names = ["path", "width", "height", "tile_width", "tile_height"]
    types = [pa.string(), *[pa.int32()] * 4]
    layout = [*names, "band", "tx", "ty", "origin_x", "origin_y", "tile"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for plan in batch.to_pylist():
                for *place, tile in _tiles(plan, unpack):
                    head = [pa.array([plan[n]], t) for n, t in zip(names, types)]
                    keys = [pa.array([p], pa.int32()) for p in place]
                    corner = [pa.array([plan[n]], pa.float64()) for n in ("origin_x", "origin_y")]
                    yield pa.RecordBatch.from_arrays([*head, *keys, *corner, tile], layout)

    planned = plan_files(files, lambda file: _plan_file(file, range_bytes), PLAN)
    return read_ranges(planned, -(-total_length(files) // range_bytes), read, SCHEMA, ("path", "first"))


def load_on_grid(spark: SparkSession, path: str, grid: Grid, band: int = 0) -> DataFrame:
    """Tiles ``(tx, ty, tile)`` of one band of one image, in the tile layout of ``grid``.

    The image must have the size of the grid, and ``path`` must match one image only: tiles of
    several images would share their keys. An image stored in other tiles, or in strips, is
    cut anew. The layout of every tile is compared again where it is read.
    """
    if len(list_files(spark, path).select("path").limit(2).collect()) != 1:
        raise ValueError(f"{path} must match exactly one image")
    tiles = raster.select_band(load_tiff(spark, path), band)
    names = ("width", "height", "tile_width", "tile_height")
    found = tiles.select(*names).first()
    if found is None or (found.width, found.height) != (grid.width, grid.height):
        raise ValueError(f"{path} has no band {band} of {grid.width} x {grid.height} pixels")
    stored = replace(grid, tile_width=found.tile_width, tile_height=found.tile_height)
    same = F.struct(*names) == F.struct(*[F.lit(getattr(stored, n)).alias(n) for n in names])
    wrong = F.raise_error(F.concat(F.lit("the image layout changes within "), "path")).cast("int")
    tiles = tiles.select(F.when(same, F.col("tx")).otherwise(wrong).alias("tx"), "ty", "tile")
    return tiles if stored == grid else raster.to_tiles(raster.flatten(tiles, stored), grid)


def load_mosaic(spark: SparkSession, path: str, grid: Grid, band: int = 0) -> DataFrame:
    """Tiles ``(tx, ty, tile)`` of one band of a raster stored as many images, such as :func:`write_tiff` leaves.

    Each image is placed by its map position. Its tiles must be those of ``grid``.
    """
    tiles = raster.select_band(load_tiff(spark, path), band)
    first_x = F.round((F.col("origin_x") - grid.x1) / grid.step_x / grid.tile_width, 6)
    first_y = F.round((F.col("origin_y") - grid.y1) / grid.step_y / grid.tile_height, 6)
    fits = (
        (F.col("tile_width") == grid.tile_width) & (F.col("tile_height") == grid.tile_height)
        & (first_x == F.floor(first_x)) & (first_y == F.floor(first_y))
    )
    wrong = F.raise_error(F.concat("path", F.lit(" does not lie on the tiles of the grid"))).cast("int")
    return tiles.select(
        F.when(fits, F.col("tx") + first_x.cast("int")).otherwise(wrong).alias("tx"),
        (F.col("ty") + first_y.cast("int")).alias("ty"), "tile",
    )


def _entry(tag: int, kind: int, values: Sequence | bytes) -> tuple[int, int, int, bytes]:
    raw = values if kind == 2 else struct.pack(f"<{len(values)}{FIELD_TYPES[kind]}", *values)
    return tag, kind, len(values), raw


def _file(entries: list[tuple[int, int, int, bytes]], blocks: list[bytes], places: list[int | None]) -> bytes:
    """A little-endian classic TIFF: directory, long values, blocks; an absent block has offset and size 0."""
    blank = [0] * len(places)
    for fill in (False, True):
        if fill:
            starts = np.cumsum([data, *[len(b) for b in blocks]]).tolist()
            if starts[-1] >= 1 << 32:
                raise ValueError("a block is over 4 GB; use fewer tiles a file")
            offsets = [0 if p is None else starts[p] for p in places]
            sizes = [0 if p is None else len(blocks[p]) for p in places]
        else:
            offsets = sizes = blank
        found = sorted([*entries, _entry(TILE_OFFSETS, 4, offsets), _entry(TILE_BYTES, 4, sizes)])
        at = 8 + 2 + 12 * len(found) + 4
        directory, extra = struct.pack("<H", len(found)), b""
        for tag, kind, count, raw in found:
            if len(raw) > 4:
                directory += struct.pack("<HHII", tag, kind, count, at + len(extra))
                extra += raw + b"\0" * (len(raw) % 2)
            else:
                directory += struct.pack("<HHI", tag, kind, count) + raw.ljust(4, b"\0")
        data = at + len(extra)
    return b"II" + struct.pack("<HI", 42, 8) + directory + b"\0" * 4 + extra + b"".join(blocks)


def write_tiff(
    tiles: DataFrame, path: str, grid: Grid, bands: Sequence[str], dtype: str = "float32", nodata: float | None = None,
    scale: float = 1.0, shift: float = 0.0, block: int = 8, overwrite: bool = False,
) -> None:
    """Write bands of a tile table as TIFF images of ``block`` x ``block`` tiles each, by many tasks.

    Values are stored as ``(value - shift) / scale`` in ``dtype`` (``u1`` packs to 8 bits), rounded for integers;
    one that the type cannot hold, or that would read as ``nodata``, is an error. Empty pixels become ``nodata``
    (needed for integers) or NaN; wholly empty tiles have no block. Images carry their map position, so
    :func:`load_mosaic` and other readers put them side by side.
    """
    kind = np.dtype(dtype).newbyteorder("<")
    if grid.tile_width % 16 or grid.tile_height % 16:
        raise ValueError("TIFF tiles need sides divisible by 16")
    if nodata is None and kind.kind != "f":
        raise ValueError("integers need a nodata value")
    empty = np.nan if nodata is None else float(nodata)
    bands = list(bands)

    def pack(values: np.ndarray) -> bytes | None:
        blank = np.isnan(values)
        if blank.all():
            return None
        stored = (values - shift) / scale
        if kind.kind != "f":
            stored = np.round(stored)
            limits = np.iinfo(kind)
            if (stored[~blank] < limits.min).any() or (stored[~blank] > limits.max).any():
                raise ValueError(f"a value does not fit {dtype} with scale {scale} and shift {shift}")
        if (stored[~blank] == empty).any():
            raise ValueError(f"a value would be stored as the nodata value {nodata}")
        return np.where(blank, empty, stored).astype(kind).tobytes()

    def encode(key: tuple, rows: list) -> dict[str, bytes]:
        by, bx = key
        first_x, first_y = bx * block, by * block
        width = min(block * grid.tile_width, grid.width - first_x * grid.tile_width)
        height = min(block * grid.tile_height, grid.height - first_y * grid.tile_height)
        across, down = -(-width // grid.tile_width), -(-height // grid.tile_height)
        blocks: list[bytes] = []
        places: list[int | None] = [None] * (across * down * len(bands))
        for batch, row in rows:
            tx, ty = batch.column("tx")[row].as_py() - first_x, batch.column("ty")[row].as_py() - first_y
            for plane, band in enumerate(bands):
                if not batch.column(band)[row].is_valid:
                    continue
                packed, place = pack(pixels_of(batch, band, row)), plane * across * down + ty * across + tx
                if packed is not None:
                    if places[place] is not None:
                        raise ValueError(f"two tiles at {tx + first_x}, {ty + first_y}")
                    places[place] = len(blocks)
                    blocks.append(packed)
        x = grid.x1 + first_x * grid.tile_width * grid.step_x
        y = grid.y1 + first_y * grid.tile_height * grid.step_y
        model = 2 if 4001 <= grid.srid <= 4999 else 1
        items = "".join(
            f'<Item name="{n.upper()}" sample="{i}" role="{n}">{v!r}</Item>'
            for i in range(len(bands)) for n, v in (("offset", float(shift)), ("scale", float(scale)))
        )
        code = {"u": 1, "i": 2, "f": 3}[kind.kind]
        entries = [
            _entry(WIDTH, 4, [width]), _entry(HEIGHT, 4, [height]), _entry(BITS, 3, [kind.itemsize * 8] * len(bands)),
            _entry(COMPRESSION, 3, [1]), _entry(PHOTOMETRIC, 3, [1]), _entry(SAMPLES, 3, [len(bands)]), _entry(PLANAR, 3, [2]),
            _entry(TILE_WIDTH, 4, [grid.tile_width]), _entry(TILE_HEIGHT, 4, [grid.tile_height]),
            _entry(SAMPLE_FORMAT, 3, [code] * len(bands)),
            _entry(TRANSFORMATION, 12, [grid.step_x, 0, 0, x, 0, grid.step_y, 0, y, 0, 0, 0, 0, 0, 0, 0, 1]),
            _entry(GEO_KEYS, 3, [1, 1, 0, 3, 1024, 0, 1, model, 1025, 0, 1, 1, 2048 if model == 2 else 3072, 0, 1, grid.srid]),
            _entry(METADATA, 2, f"<GDALMetadata>{items}</GDALMetadata>".encode() + b"\0"),
        ]
        if len(bands) > 1:
            entries.append(_entry(EXTRA_SAMPLES, 3, [0] * (len(bands) - 1)))
        if nodata is not None:
            entries.append(_entry(NODATA, 2, f"{nodata!r}".encode() + b"\0"))
        return {".tif": _file(entries, blocks, places)}

    keyed = tiles.where(
        F.col("tx").between(0, grid.tiles_across - 1) & F.col("ty").between(0, grid.tiles_down - 1)
    ).select(F.expr(f"ty div {block}").cast("int").alias("_by"), F.expr(f"tx div {block}").cast("int").alias("_bx"), "tx", "ty", *bands)
    write_blocks(keyed, path, "tiff_blocks", ["_by", "_bx"], ["ty", "tx"], encode, overwrite)
