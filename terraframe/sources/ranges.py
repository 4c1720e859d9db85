"""Large binary files by byte range, and block files written by many tasks.

Readers list files with Spark, plan ranges of about :data:`RANGE_BYTES` in tasks and read
each range in a task of its own, so a file of any size is the work of many. Files are
opened with Arrow's file systems (local, HDFS, S3, Google and Azure storage).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter

from .writers import Part, StagedOutput, qualified

RANGE_BYTES = 32 << 20
DOUBLES = pa.list_(pa.field("element", pa.float64()))
TYPES = {
    "string": pa.string(), "boolean": pa.bool_(), "int": pa.int32(), "long": pa.int64(), "double": pa.float64(),
    "array<long>": pa.list_(pa.field("element", pa.int64())), "array<double>": DOUBLES,
}


def open_file(path: str) -> pa.NativeFile:
    """A file for reads at any place; ``path`` as Spark lists it, with or without a scheme."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem().open_input_file(path)
    scheme, rest = path.split("://", 1)
    host, _, inner = rest.partition("/")
    system, root = fs.FileSystem.from_uri(f"{scheme}://{host}/")
    return system.open_input_file(f"{root.rstrip('/')}/{inner}" if root.strip("/") else ("/" if scheme == "hdfs" else "") + inner)


def read_exactly(file: pa.NativeFile, size: int, at: int) -> bytes:
    raw = file.read_at(size, at)
    if len(raw) != size:
        raise ValueError(f"a file ends at {at + len(raw)}, {at + size} bytes were announced")
    return raw


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """``path, length`` of the files at ``path``; no content is read."""
    reader = spark.read.format("binaryFile")
    return (reader.option("pathGlobFilter", glob) if glob else reader).load(path).select("path", "length")


def plan_files(files: DataFrame, plan: Callable[[str], Iterator[dict]], schema: str) -> DataFrame:
    """The ranges of each file, found by the task that meets the file; ``schema`` is made of :data:`TYPES`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([(name, TYPES[kind]) for name, kind in (c.split() for c in schema.split(", "))])
        for batch in batches:
            for path in batch.column("path").to_pylist():
                for row in plan(path):
                    yield pa.RecordBatch.from_pylist([row], kinds)

    return files.select("path").mapInArrow(run, schema)


def read_ranges(planned: DataFrame, tasks: int, read: Callable, schema: str, keys: tuple[str, ...]) -> DataFrame:
    """Hand the planned ranges to their tasks.

    The number of tasks is given by the caller, from the bytes to read, since rows that only describe ranges are too small for
    adaptive execution to leave them apart.
    """
    return planned.repartition(max(1, tasks), *keys).mapInArrow(read, schema)


def total_length(files: DataFrame) -> int:
    return files.agg(F.sum("length")).first()[0] or 0


def doubles(values: np.ndarray, empty: np.ndarray) -> pa.Array:
    """One list of numbers with nulls where ``empty``; no object is made for a pixel."""
    flat = pa.array(values.ravel(), pa.float64(), mask=empty.ravel())
    return pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat, type=DOUBLES)


def pixels_of(batch: pa.RecordBatch, band: str, row: int) -> np.ndarray:
    """A tile of a batch as numbers, NaN where it is empty."""
    return batch.column(band)[row].values.to_numpy(zero_copy_only=False)


class _BlockWriter(StagedOutput, DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool, keys: list[str], encode: Callable) -> None:
        super().__init__(path, overwrite)
        self.keys, self.encode = keys, encode

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        names: list[str] = []
        key, held = None, []
        for batch in iterator:
            columns = [batch.column(k).to_pylist() for k in self.keys]
            for row, found in enumerate(zip(*columns)):
                if found != key and held:
                    names += self._store(key, held)
                    held = []
                key = found
                held.append((batch, row))
        if held:
            names += self._store(key, held)
        return Part(names)

    def _store(self, key: tuple, rows: list) -> list[str]:
        stem = "part-" + "-".join(str(k) for k in key)
        return self.stage(stem, self.encode(key, rows))


def write_blocks(
    rows: DataFrame, path: str, name: str, keys: list[str], order: list[str], encode: Callable[[tuple, list], dict[str, Any]],
    overwrite: bool = False,
) -> None:
    """One file (or set of files, by extension) for the rows of each key, written by many tasks.

    ``encode(key, rows)`` gets all ``(batch, row)`` of one key, of which there must be boundedly many, and
    returns bytes by extension. Files appear when the whole job has committed.
    """
    spark = rows.sparkSession
    default = spark._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
            return _BlockWriter(qualified(self.options["path"], default), overwrite, keys, encode)

    spark.dataSource.register(Source)
    placed = rows.repartition(*keys).sortWithinPartitions(*keys, *order)
    placed.write.format(name).mode("overwrite" if overwrite else "append").save(path)
