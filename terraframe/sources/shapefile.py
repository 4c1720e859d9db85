"""Shapefiles, zipped or as ``.shp`` + ``.shx`` + ``.dbf``, as a Spark data source.

With its ``.shx`` index a file is read in ranges of records by many tasks; without one, or in an archive, a file is
one task's work. Filters on the box columns reach the reader, which then skips records by their coordinates before
anything else of them is built. Coordinates go to Spark as Arrow arrays, not as objects.
"""

from __future__ import annotations

import codecs
import itertools
import struct
import zipfile
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan,
    LessThanOrEqual,
)

from .ranges import RANGE_BYTES, open_file, read_exactly
from .writers import Part, StagedOutput, open_folder, qualified

BOX = ("minx", "miny", "maxx", "maxy")
SCHEMA = (
    "geom_type string, x double, y double, rings array<array<struct<x:double,y:double>>>, "
    "attributes map<string,string>, minx double, miny double, maxx double, maxy double"
)
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
ROWS_PER_BATCH, BATCH_BYTES = 2000, 8 << 20
# Shape type codes of the format; codes + 10 and + 20 carry more ordinates after these.
TYPES = {1: "Point", 3: "LineString", 5: "Polygon"}
# Code pages by the language byte of a table.
LANGUAGES = {0x01: "cp437", 0x02: "cp850", 0x03: "cp1252", 0x57: "cp1252", 0x64: "cp852", 0x65: "cp866", 0xC8: "cp1250", 0xC9: "cp1251"}
POINT = pa.struct([("x", pa.float64()), ("y", pa.float64())])
RINGS = pa.list_(pa.field("element", pa.list_(pa.field("element", POINT))))


@dataclass
class _Range(InputPartition):
    path: str
    first: int = 0
    last: int | None = None
    siblings: tuple[str, ...] = ()


class _Table:
    """Records of a ``.dbf`` file by number."""

    def __init__(self, file: pa.NativeFile, code_page: str | None) -> None:
        self.file = file
        head = read_exactly(file, 32, 0)
        self.count, self.start, self.length = struct.unpack_from("<IHH", head, 4)
        fields = read_exactly(file, self.start - 32, 32)
        self.fields, offset = [], 1
        for at in range(0, len(fields) - 31, 32):
            if fields[at] == 0x0D:
                break
            name = fields[at : at + 11].split(b"\0")[0].decode("latin-1")
            self.fields.append((name, offset, offset + fields[at + 16]))
            offset += fields[at + 16]
        self.codec = _codec(code_page) if code_page else LANGUAGES.get(head[29])

    def text(self, raw: bytes) -> str:
        if self.codec:
            return raw.decode(self.codec).strip()
        try:
            return raw.decode("utf-8").strip()
        except UnicodeDecodeError:
            return raw.decode("latin-1").strip()

    def lines(self, first: int, last: int) -> list[bytes]:
        raw = read_exactly(self.file, (last - first) * self.length, self.start + first * self.length)
        return [raw[i : i + self.length] for i in range(0, len(raw), self.length)]

    def attributes(self, line: bytes) -> list[tuple[str, str]]:
        return [(name, self.text(line[a:b])) for name, a, b in self.fields]


def _codec(code_page: str) -> str:
    """Python's name for what a ``.cpg`` file says."""
    name = code_page.strip().lower().removeprefix("ansi ").removeprefix("oem ")
    if name.isdigit():
        name = {"65001": "utf-8"}.get(name) or (f"iso8859-{name[4:]}" if name.startswith("8859") else f"cp{name}")
    return codecs.lookup(name).name


def _offsets(shp: pa.NativeFile) -> list[tuple[int, int]]:
    """Place and size of every record of a file without an index."""
    at, end, found = 100, shp.size(), []
    while at + 8 <= end:
        size = 2 * struct.unpack_from(">i", shp.read_at(8, at), 4)[0]
        found.append((at + 8, size))
        at += 8 + size
    return found


def _shape(raw: bytes) -> tuple[str | None, np.ndarray | None, np.ndarray | None]:
    """Kind, positions and starts of the parts of a record."""
    code = struct.unpack_from("<i", raw)[0]
    if code == 0:
        return None, None, None
    kind = TYPES.get(code % 10)
    if kind is None:
        raise ValueError(f"shape type {code} is not supported")
    if kind == "Point":
        return kind, np.frombuffer(raw, "<f8", 2, 4).reshape(1, 2), None
    n_parts, n_points = struct.unpack_from("<2i", raw, 36)
    firsts = np.frombuffer(raw, "<i4", n_parts, 44)
    xy = np.frombuffer(raw, "<f8", 2 * n_points, 44 + 4 * n_parts).reshape(-1, 2)
    return ("Multi" if n_parts > 1 else "") + kind, xy, firsts


class _Batch:
    """Columns of some features, built from whole coordinate arrays."""

    def __init__(self) -> None:
        self.kinds: list[str | None] = []
        self.points: list[np.ndarray] = []
        self.boxes: list[tuple] = []
        self.xy: list[np.ndarray] = []
        self.ring_ends, self.ends = [0], [0]
        self.shaped: list[bool] = []
        self.attributes: list[list[tuple[str, str]]] = []

    def add(self, kind: str | None, xy: np.ndarray | None, firsts: np.ndarray | None, box: tuple, attributes: list) -> None:
        self.kinds.append(kind)
        self.points.append(xy[0] if kind == "Point" else (None, None))
        self.boxes.append(box)
        self.shaped.append(firsts is not None)
        if firsts is not None:
            base = self.ring_ends[-1]
            self.xy.append(xy)
            self.ring_ends += [base + int(f) for f in firsts[1:]] + [base + len(xy)]
        self.ends.append(len(self.ring_ends) - 1)
        self.attributes.append(attributes)

    def arrow(self) -> pa.RecordBatch:
        xy = np.concatenate(self.xy) if self.xy else np.empty((0, 2))
        columns = [pa.array(np.ascontiguousarray(xy[:, i]), pa.float64()) for i in (0, 1)]
        rings = pa.ListArray.from_arrays(
            pa.array(self.ring_ends, pa.int32()), pa.StructArray.from_arrays(columns, fields=list(POINT)), type=RINGS.value_type
        )
        # An offset of null makes a feature without rings null.
        starts = [e if s else None for e, s in zip(self.ends, self.shaped)] + [self.ends[-1]]
        shapes = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), rings, type=RINGS)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(self.kinds, pa.string()), *[pa.array([p[i] for p in self.points], pa.float64()) for i in (0, 1)], shapes,
                pa.array(self.attributes, pa.map_(pa.string(), pa.string())),
                *[pa.array([b[i] for b in self.boxes], pa.float64()) for i in range(4)],
            ],
            ["geom_type", "x", "y", "rings", "attributes", *BOX],
        )


def _run(places: list[tuple[int, int]], start: int) -> list[tuple[int, int]]:
    """Records from ``start`` on that make a batch: bounded in number and in bytes."""
    end, held = start + 1, places[start][1]
    while end < len(places) and end - start < ROWS_PER_BATCH and held + places[end][1] <= BATCH_BYTES:
        held += places[end][1]
        end += 1
    return places[start:end]


def _features(
    shp: pa.NativeFile, index: pa.NativeFile | None, table: _Table | None, first: int, last: int | None, keep
) -> Iterator[pa.RecordBatch]:
    announced = 2 * struct.unpack_from(">i", read_exactly(shp, 100, 0), 24)[0]
    if shp.size() < announced:
        raise ValueError(f"a shapefile ends at {shp.size()} of {announced} bytes")
    if index is None:
        places = _offsets(shp)
        total = len(places)
    else:
        total = (index.size() - 100) // 8
        last = total if last is None else last
        words = np.frombuffer(read_exactly(index, 8 * (last - first), 100 + 8 * first), ">i4").reshape(-1, 2).astype("int64")
        places = [(2 * at + 8, 2 * size) for at, size in words.tolist()]
    last = total if last is None else last
    # With a table, every shape has its record and every record its shape.
    if table is not None and table.count != total:
        raise ValueError(f"{total} shapes but {table.count} records in the table")
    start = 0
    while start < len(places):
        run = _run(places, start)
        lines = table.lines(first + start, first + start + len(run)) if table else [b" "] * len(run)
        start += len(run)
        # Records lie one after another, so a run is read at once unless there are holes in it.
        low, high = min(at for at, _ in run), max(at + size for at, size in run)
        whole = high - low <= 2 * BATCH_BYTES or len(run) == 1
        raw = read_exactly(shp, high - low, low) if whole else b""
        batch = _Batch()
        for (at, size), line in zip(run, lines):
            if line[:1] == b"*":
                continue
            kind, xy, firsts = _shape(raw[at - low : at - low + size] if whole else read_exactly(shp, size, at))
            box = (None,) * 4 if xy is None or not len(xy) else (*xy.min(axis=0).tolist(), *xy.max(axis=0).tolist())
            if keep(box):
                batch.add(kind, xy, firsts, box, table.attributes(line) if table else [])
        if batch.kinds:
            yield batch.arrow()


class _Reader(DataSourceReader):
    def __init__(self, path: str, range_bytes: int) -> None:
        self.path, self.range_bytes = path, range_bytes
        self.limits: list[tuple[int, str, float]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Remember the limits on box columns; Spark tests what is left again."""
        kinds = {LessThanOrEqual: "<=", LessThan: "<=", GreaterThanOrEqual: ">=", GreaterThan: ">="}
        for test in filters:
            sign = kinds.get(type(test))
            if sign and len(test.attribute) == 1 and test.attribute[0] in BOX:
                self.limits.append((BOX.index(test.attribute[0]), sign, float(test.value)))
            yield test

    def _keep(self, box: tuple) -> bool:
        return all(
            box[i] is not None and (box[i] <= value if sign == "<=" else box[i] >= value) for i, sign, value in self.limits
        )

    def partitions(self) -> list[_Range]:
        """Record ranges from file sizes alone; no file is opened."""
        system, path = open_folder(self.path)
        stem = path[:-4] if path.lower().endswith(".shp") else None
        if path.lower().endswith(".zip"):
            return [_Range(self.path)]
        folder = path.rsplit("/", 1)[0] if stem else path
        found = system.get_file_info(fs.FileSelector(folder, recursive=stem is None))
        prefix = self.path[: len(self.path.rstrip("/")) - len(path.rstrip("/"))]
        stems: dict[str, dict[str, fs.FileInfo]] = {}
        for info in found:
            if info.type == fs.FileType.File and "/_" not in info.path[len(folder) :]:
                base, _, extension = info.path.rpartition(".")
                if stem is None or base == stem:
                    stems.setdefault(base, {})[extension.lower()] = info
        ranges = []
        for base, files in sorted(stems.items()):
            if "zip" in files:
                ranges.append(_Range(prefix + files["zip"].path))
            if "shp" not in files:
                continue
            siblings = tuple(prefix + files[e].path for e in ("shx", "dbf", "cpg") if e in files)
            shape = prefix + files["shp"].path
            if "shx" not in files:
                ranges.append(_Range(shape, siblings=siblings))
                continue
            total = (files["shx"].size - 100) // 8
            parts = max(1, -(-files["shp"].size // self.range_bytes))
            cuts = [total * i // parts for i in range(parts + 1)]
            ranges += [_Range(shape, a, b, siblings) for a, b in itertools.pairwise(cuts) if a < b]
        if stem is not None and not ranges and not any("shp" in files for files in stems.values()):
            raise FileNotFoundError(self.path)
        return ranges or [_Range("")]

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        if partition.path.lower().endswith(".zip"):
            with open_file(partition.path) as packed, zipfile.ZipFile(packed) as archive:
                names = {n.lower(): n for n in archive.namelist()}
                for name in sorted(n for n in names if n.endswith(".shp")):
                    held = {e: archive.read(names[name[:-3] + e]) for e in ("shp", "dbf", "cpg") if name[:-3] + e in names}
                    page = held["cpg"].decode("ascii") if "cpg" in held else None
                    table = _Table(pa.BufferReader(held["dbf"]), page) if "dbf" in held else None
                    yield from _features(pa.BufferReader(held["shp"]), None, table, 0, None, self._keep)
        elif partition.path:
            by = {p.rpartition(".")[2].lower(): p for p in partition.siblings}
            page = open_file(by["cpg"]).read().decode("ascii") if "cpg" in by else None
            table = _Table(open_file(by["dbf"]), page) if "dbf" in by else None
            index = open_file(by["shx"]) if "shx" in by else None
            with open_file(partition.path) as shp:
                yield from _features(shp, index, table, partition.first, partition.last, self._keep)


class _Files:
    """Bytes of one set of files while features are added."""

    def __init__(self, code: int) -> None:
        self.code, self.body, self.index, self.rows = code, [], [], []
        self.at = 50
        self.box = [np.inf, np.inf, -np.inf, -np.inf]

    def add(self, content: bytes, xy: np.ndarray, attributes: list[bytes]) -> None:
        words = len(content) // 2
        self.body.append(struct.pack(">2i", len(self.rows) + 1, words) + content)
        self.index.append(struct.pack(">2i", self.at, words))
        self.at += 4 + words
        self.rows.append(attributes)
        if len(xy):
            low, high = xy.min(axis=0), xy.max(axis=0)
            self.box = [*np.minimum(self.box[:2], low).tolist(), *np.maximum(self.box[2:], high).tolist()]

    def contents(self, names: list[str]) -> dict[str, bytes]:
        def head(words: int) -> bytes:
            box = self.box if np.isfinite(self.box[0]) else [0.0] * 4
            return struct.pack(">i20xi", 9994, words) + struct.pack("<2i8d", 1000, self.code, *box, 0, 0, 0, 0)

        widths = [max(1, *(len(r[i]) for r in self.rows)) for i in range(len(names))]
        if any(w > 254 for w in widths):
            raise ValueError("an attribute is longer than the 254 bytes of a shapefile's table")
        fields = b"".join(struct.pack("<11sc4xBB14x", n.encode("ascii"), b"C", w, 0) for n, w in zip(names, widths))
        table = struct.pack("<4BIHH20x", 3, 70, 1, 1, len(self.rows), 33 + len(fields), 1 + sum(widths)) + fields + b"\r"
        lines = [b" " + b"".join(v.ljust(w) for v, w in zip(row, widths)) for row in self.rows]
        return {
            ".shp": head(self.at) + b"".join(self.body), ".shx": head(50 + 4 * len(self.rows)) + b"".join(self.index),
            ".dbf": table + b"".join(lines) + b"\x1a", ".cpg": b"UTF-8",
        }


class _Writer(StagedOutput, DataSourceArrowWriter):
    """Sets of files of one shape type and at most about ``range_bytes`` each."""

    def __init__(self, path: str, overwrite: bool, names: list[str], range_bytes: int) -> None:
        super().__init__(path, overwrite)
        self.names, self.range_bytes = names, range_bytes

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        held: dict[int, _Files] = {}
        names: list[str] = []
        for batch in iterator:
            attributes = [[("" if v is None else v).encode() for v in batch.column(n).to_pylist()] for n in self.names]
            kinds = batch.column("geom_type").to_pylist()
            xs, ys, shapes = batch.column("x"), batch.column("y"), batch.column("rings")
            for i, kind in enumerate(kinds):
                code = next((c for c, n in TYPES.items() if kind in (n, f"Multi{n}")), 0)
                if kind is not None and (code == 0 or kind == "MultiPoint"):
                    raise ValueError(f"{kind} cannot be written to a shapefile")
                if code == 0:
                    xy, content = np.empty((0, 2)), struct.pack("<i", 0)
                elif code == 1:
                    xy = np.array([[xs[i].as_py(), ys[i].as_py()]])
                    content = struct.pack("<i", 1) + xy.astype("<f8").tobytes()
                else:
                    rings = shapes[i].values
                    ends = rings.offsets.to_numpy() - rings.offsets[0].as_py()
                    xy = np.column_stack([rings.flatten().field(n).to_numpy() for n in (0, 1)])
                    content = struct.pack("<i4d2i", code, *xy.min(axis=0), *xy.max(axis=0), len(ends) - 1, len(xy))
                    content += ends[:-1].astype("<i4").tobytes() + xy.astype("<f8").tobytes()
                # Features without a shape go with any type.
                files = held.setdefault(code or next(iter(held), 1), _Files(code or next(iter(held), 1)))
                files.add(content, xy, [column[i] for column in attributes])
                if 2 * files.at > self.range_bytes:
                    names += self.stage("part", held.pop(files.code).contents(self.names))
        for files in held.values():
            names += self.stage("part", files.contents(self.names))
        return Part(names)


class ShapefileSource(DataSource):
    """``spark.read.format("shapefile")`` once :func:`register` has been called."""

    @classmethod
    def name(cls) -> str:
        return "shapefile"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self._path(), int(self.options.get("range_bytes", RANGE_BYTES)))

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        names = [f.name for f in schema.fields if f.name not in ("geom_type", "x", "y", "rings", *BOX)]
        return _Writer(self._path(), overwrite, names, int(self.options.get("range_bytes", RANGE_BYTES)))

    def _path(self) -> str:
        return qualified(self.options["path"], self.options.get("default_fs", "file:///"))


def register(spark: SparkSession) -> None:
    """Make the format known and let Spark hand filters to readers written in Python."""
    spark.conf.set(PUSHDOWN, "true")
    spark.dataSource.register(ShapefileSource)


def _default_fs(spark: SparkSession) -> str:
    return spark._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")


def load_shapefile(
    spark: SparkSession, path: str, attributes: list[str] | None = None, range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """Features with ``geom_type, x, y, rings``, their attributes and their box.

    ``attributes`` names the ones that become string columns; without it all of them
    stay in one ``map<string,string>`` column. Deleted records are left out. Text is read by the ``.cpg`` file
    or the language byte of the table; where neither says anything it is UTF-8, or Latin-1 if it cannot be that.
    """
    register(spark)
    reader = spark.read.format("shapefile").option("default_fs", _default_fs(spark)).option("range_bytes", range_bytes)
    features = reader.load(path)
    if attributes is not None:
        columns = [F.col("attributes")[a].alias(a) for a in attributes]
        features = features.select(*columns, "geom_type", "x", "y", "rings", *BOX)
    return features


def write_shapefile(features: DataFrame, path: str, mode: str = "errorifexists", range_bytes: int = RANGE_BYTES) -> None:
    """Write features as sets of shapefiles by many tasks; other columns become text attributes.

    Names of attributes have at most 10 ASCII characters. Without ``geom_type``, rings are polygons. Null attributes
    come back empty.
    """
    spark = features.sparkSession
    register(spark)
    names = [c for c in features.columns if c not in ("geom_type", "x", "y", "rings", *BOX)]
    if any(len(n) > 10 or not n.isascii() for n in names):
        raise ValueError(f"names of attributes are limited to 10 ASCII characters: {names}")
    rings = F.col("rings") if "rings" in features.columns else F.lit(None).cast("array<array<struct<x:double,y:double>>>")
    x, y = (F.col(n) if n in features.columns else F.lit(None).cast("double") for n in ("x", "y"))
    kind = F.when(rings.isNotNull(), "Polygon").when(x.isNotNull(), "Point")
    kind = F.col("geom_type") if "geom_type" in features.columns else kind
    rows = features.select(kind.alias("geom_type"), x.alias("x"), y.alias("y"), rings.alias("rings"), *[F.col(n).cast("string") for n in names])
    writer = rows.write.format("shapefile").option("default_fs", _default_fs(spark)).option("range_bytes", range_bytes)
    writer.mode("overwrite" if mode == "overwrite" else "append").save(path)
