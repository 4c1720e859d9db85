"""Custom feature writers as a Spark data source.

A writer class opens one file per output part, is handed every row once and closes
the file. :func:`register_feature_writer` turns it into a format for ``df.write``.
Files appear under their final names only when the whole job has committed, so lost
or repeated tasks leave no partial output.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO

from pyarrow import fs
from pyspark.sql import Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType


class FeatureWriter:
    """Base class of custom writers."""

    short_name = "custom"
    extension = ""

    def initialize(self, out: BinaryIO, schema: StructType) -> None:
        """Called once per part, before the first row."""
        self.out = out

    def write(self, row: Row) -> None:
        """Called once per row; rows must not be kept."""
        raise NotImplementedError

    def close(self) -> None:
        """Called after the last row; the file itself is closed by the caller."""


@dataclass
class Part(WriterCommitMessage):
    names: list[str]


def qualified(path: str, default: str) -> str:
    """A path with its file system: without a scheme it lies in Spark's default one, as for Spark's own writers."""
    if "://" in path or path.startswith("file:") or default.startswith("file:"):
        return path
    if not path.startswith("/"):
        raise ValueError(f"a path in {default} must be absolute, not {path!r}")
    return default.rstrip("/") + path


def open_folder(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class StagedOutput:
    """Files of tasks wait in a folder of the job until all of it has succeeded."""

    def __init__(self, path: str, overwrite: bool) -> None:
        self.path, self.overwrite = path, overwrite
        self.staging = f"{path.rstrip('/')}/_temporary-{uuid.uuid4().hex}"

    def stage(self, stem: str, contents: dict[str, bytes]) -> list[str]:
        """Write one file for each extension; names are new, so a repeated task disturbs none."""
        system, folder = open_folder(self.staging)
        system.create_dir(folder, recursive=True)
        stem = f"{stem}-{uuid.uuid4().hex}"
        for extension, content in contents.items():
            with system.open_output_stream(f"{folder}/{stem}{extension}") as out:
                out.write(content)
        return [stem + extension for extension in contents]

    def commit(self, messages: list[Part | None]) -> None:
        system, target = open_folder(self.path)
        _, staging = open_folder(self.staging)
        found = system.get_file_info(fs.FileSelector(target, allow_not_found=True))
        old = [f for f in found if f.base_name.startswith("part-")]
        if old and not self.overwrite:
            self.abort(messages)
            raise FileExistsError(f"{self.path} already holds features; write in overwrite mode")
        # New parts first, so that a failure never leaves fewer features than before.
        for message in messages:
            for name in message.names if message is not None else []:
                system.move(f"{staging}/{name}", f"{target}/{name}")
        for file in old:
            system.delete_file(file.path)
        if system.get_file_info(staging).type == fs.FileType.Directory:
            system.delete_dir(staging)

    def abort(self, messages: list[Part | None]) -> None:
        system, staging = open_folder(self.staging)
        if system.get_file_info(staging).type == fs.FileType.Directory:
            system.delete_dir(staging)


class _PartWriter(StagedOutput, DataSourceWriter):
    def __init__(self, writer: type[FeatureWriter], schema: StructType, path: str, overwrite: bool) -> None:
        super().__init__(path, overwrite)
        self.writer, self.schema = writer, schema

    def write(self, iterator: Iterator[Row]) -> Part:
        name = f"part-{uuid.uuid4().hex}{self.writer.extension}"
        system, folder = open_folder(self.staging)
        system.create_dir(folder, recursive=True)
        writer = self.writer()
        with system.open_output_stream(f"{folder}/{name}") as out:
            writer.initialize(out, self.schema)
            for row in iterator:
                writer.write(row)
            writer.close()
        return Part([name])


def register_feature_writer(spark: SparkSession, writer: type[FeatureWriter]) -> None:
    """Make ``df.write.format(writer.short_name).save(path)`` use the writer class.

    Spark offers modes ``append`` and ``overwrite`` to such sources; ``append`` is
    refused when the folder already holds features, as the default of a write is.
    """
    default = spark._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return writer.short_name

        def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
            return _PartWriter(writer, schema, qualified(self.options["path"], default), overwrite)

    spark.dataSource.register(Source)
