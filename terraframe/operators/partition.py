"""Spatial partitioning by size, and the index written from it.

Space is cut into vertical strips of equal bytes, and every strip into rows of equal bytes. The cuts are quantile
sketches in which a feature counts by its measured size; they are merged map-side, so neither a global sort nor a sample
on the driver is needed. Cuts of rows stay in a written table with one line per strip.

The index stores features by partition and along a curve within it. Beside it lies a packed tree as a table:
files, the partitions above them, the strips above those, each with its box. A range query goes down the tree and
opens the files it leads to.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import Box
from ..functions.sizes import row_bytes
from ..session import shared_folder
from .spatial_join import envelope_join
from .vector import BOX, range_query, with_envelope

PART_BYTES = FILE_BYTES = 128 << 20
# A partition's share is worth this many entries of the sketch.
UNITS = 1000
# A table is broadcast below this many bytes, by its counted rows.
BROADCAST_BYTES = 64 << 20
# Files opened by name; a query that meets more of them reads whole partitions.
NAMED_FILES = 10_000


def _count_at_most(cuts: Column, value: Column, length: int) -> Column:
    """How many of the sorted ``cuts`` are <= ``value``, by binary search."""
    steps = [2**i for i in range(max(length, 1).bit_length() - 1, -1, -1)]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, step: F.when(
            (at + step <= F.size(cuts)) & (F.get(cuts, at + step - 1) <= value), at + step
        ).otherwise(at),
    )


def total_bytes(features: DataFrame) -> int:
    """Bound for the size of all features in memory."""
    return int(features.agg(F.coalesce(F.sum(row_bytes(features)), F.lit(0))).first()[0])


@dataclass(frozen=True)
class SpatialPartitioner:
    """Cuts of the plane: ``x_cuts`` between strips, ``y_cuts[s]`` within strip ``s``.

    Instead of ``y_cuts``, fitted cuts of rows are in the table ``strips`` (``strip, cuts``), at most ``most_cuts`` in a strip.
    """

    x_cuts: tuple[float, ...]
    y_cuts: tuple[tuple[float, ...], ...] = ()
    strips_table: DataFrame | None = field(default=None, compare=False)
    most_cuts: int = 0
    bytes: int = 0

    @property
    def rows(self) -> int:
        return max([self.most_cuts, *map(len, self.y_cuts)]) + 1

    @property
    def strips(self) -> int:
        return len(self.x_cuts) + 1

    @classmethod
    def fit(
        cls, features: DataFrame, partitions: int | None = None, accuracy: int = 10_000, *,
        part_bytes: int = PART_BYTES, size: int | None = None,
    ) -> SpatialPartitioner:
        """Cuts that give parts of about equal bytes, by the centre of each feature's box.

        Without ``partitions`` there are as many as hold ``part_bytes`` each. ``size`` is the size of all features, if it
        is known. A feature enters the sketch once per unit of its size, a unit being a thousandth of a part;
        what is left of a unit is rounded up or down by chance, so that sums hold.
        """
        if partitions is not None and partitions < 1:
            raise ValueError("partitions must be at least 1")
        size = total_bytes(features) if size is None else size
        partitions = partitions or max(1, -(-size // part_bytes))
        strips = max(1, round(math.sqrt(partitions)))
        rows = -(-partitions // strips)
        boxed = features if "minx" in features.columns else with_envelope(features)
        units = row_bytes(features) * F.lit(UNITS * partitions / max(size, 1)) + F.rand(42)
        centre = boxed.select(
            ((F.col("minx") + F.col("maxx")) / 2).alias("x"), ((F.col("miny") + F.col("maxy")) / 2).alias("y"),
            F.floor(units).cast("int").alias("units"),
        ).where(F.col("x").isNotNull() & F.col("y").isNotNull() & (F.col("units") > 0))
        weighted = centre.select("x", "y", F.explode(F.sequence(F.lit(1), "units"))).drop("col")

        def cuts(column: str, parts: int) -> Column:
            wanted = [i / parts for i in range(1, parts)]
            found = F.percentile_approx(column, wanted, max(accuracy, 50 * parts)) if wanted else F.array().cast("array<double>")
            return F.array_sort(F.array_distinct(F.coalesce(found, F.array().cast("array<double>"))))

        x_cuts = tuple(weighted.agg(cuts("x", strips).alias("c")).first()["c"])
        by_strip = weighted.select(cls(x_cuts).strip_of(F.col("x")).alias("strip"), "y").groupBy("strip").agg(cuts("y", rows).alias("cuts"))
        spark, path = features.sparkSession, shared_folder(features.sparkSession, "strips")
        by_strip.write.parquet(path)
        table = spark.read.schema("strip int, cuts array<double>").parquet(path)
        most = table.agg(F.coalesce(F.max(F.size("cuts")), F.lit(0))).first()[0]
        return cls(x_cuts, (), table, most, size)

    def strip_of(self, x: Column) -> Column:
        return _count_at_most(_constant(self.x_cuts, "array<double>"), x, len(self.x_cuts))

    def _with_cuts(self, placed: DataFrame) -> DataFrame:
        """Add the cuts of each row's ``_strip``."""
        if self.strips_table is None:
            return placed.withColumn("_cuts", F.get(_constant(self.y_cuts, "array<array<double>>"), F.col("_strip")))
        table = self.strips_table.toDF("_strip", "_found")
        # One line per strip, as many as the root of the number of parts.
        small = self.strips * (8 * self.most_cuts + 64) <= BROADCAST_BYTES
        joined = placed.join(F.broadcast(table) if small else table, "_strip", "left")
        return joined.withColumn("_cuts", F.coalesce("_found", F.array().cast("array<double>"))).drop("_found")

    def _row_of(self, y: Column) -> Column:
        return _count_at_most(F.col("_cuts"), y, self.rows - 1)

    def assign(self, features: DataFrame, alias: str = "part_id", home: str | None = None) -> DataFrame:
        """Add the partition number; a box that crosses a cut occurs in every part it meets.

        ``home`` names a flag that is true on one copy of each feature only, the one in
        the part of its lower-left corner.
        """
        columns = features.columns
        if not is_boxed(features):
            placed = self._with_cuts(features.withColumn("_strip", self.strip_of(F.col("x"))))
            number = F.col("_strip") * self.rows + self._row_of(F.col("y"))
            flags = {home: F.lit(True)} if home else {}
            return placed.withColumns({alias: number, **flags}).select(*columns, alias, *flags)
        boxed = features if "minx" in columns else with_envelope(features)
        placed = boxed.withColumn("_first", self.strip_of(F.col("minx"))).withColumn(
            "_strip", F.explode(F.sequence(F.col("_first"), self.strip_of(F.col("maxx"))))
        )
        placed = self._with_cuts(placed).withColumn("_low", self._row_of(F.col("miny")))
        placed = placed.withColumn("_row", F.explode(F.sequence(F.col("_low"), self._row_of(F.col("maxy")))))
        flags = {home: (F.col("_strip") == F.col("_first")) & (F.col("_row") == F.col("_low"))} if home else {}
        return placed.withColumns({alias: F.col("_strip") * self.rows + F.col("_row"), **flags}).select(*columns, alias, *flags)


def is_boxed(features: DataFrame) -> bool:
    """Whether features have an extent, so that one may lie in several parts."""
    return "x" not in features.columns or "rings" in features.columns


def _constant(values: Sequence, ddl: str) -> Column:
    """A nested array as one literal: parsed once by the optimizer, however many cuts there are."""
    return F.from_json(F.lit(json.dumps(values)), ddl)


def partition_summary(assigned: DataFrame, alias: str = "part_id") -> DataFrame:
    """Features, size and box of every partition."""
    size = row_bytes(assigned.drop(alias)).cast("bigint")
    boxed = assigned if "minx" in assigned.columns else with_envelope(assigned)
    return boxed.groupBy(alias).agg(
        F.count("*").alias("n_features"), F.sum(size).alias("n_bytes"),
        F.min("minx").alias("minx"), F.min("miny").alias("miny"),
        F.max("maxx").alias("maxx"), F.max("maxy").alias("maxy"),
    )


def overlapping_parts(summary: DataFrame, alias: str = "part_id") -> DataFrame:
    """Pairs of partitions whose boxes share a point; none if features without extent are partitioned."""
    left = summary.select(F.col(alias).alias("part_a"), *[F.col(c).alias(f"_{c}") for c in BOX])
    right = summary.select(F.col(alias).alias("part_b"), *BOX)
    return envelope_join(left, right, left_box=[f"_{c}" for c in BOX]).where("part_a < part_b").select("part_a", "part_b")


def z_order(x: Column, y: Column, extent: Box, bits: int = 16) -> Column:
    """Position along a Z-shaped curve over ``extent``."""
    top = (1 << bits) - 1

    def scaled(value: Column, low: float, high: float) -> Column:
        share = (value - F.lit(low)) / F.lit((high - low) or 1.0)
        return F.greatest(F.lit(0), F.least(F.lit(top), F.floor(share * F.lit(float(top))))).cast("bigint")

    # Bits of both numbers, interleaved by the usual doubling of the gaps.
    masks = [(8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)]

    def spread(value: Column) -> Column:
        for shift, mask in masks:
            value = value.bitwiseOR(F.shiftleft(value, shift)).bitwiseAND(F.lit(mask))
        return value

    return spread(scaled(x, extent.minx, extent.maxx)).bitwiseOR(
        F.shiftleft(spread(scaled(y, extent.miny, extent.maxy)), 1)
    )


def write_index(
    features: DataFrame, partitioner: SpatialPartitioner, path: str, *,
    mode: str = "errorifexists", files: int | None = None, extent: Box | None = None, file_bytes: int = FILE_BYTES,
) -> None:
    """Store features by partition, with a tree of boxes beside them.

    Rows are range-partitioned by (part, Z-order, row hash): all tasks get equal
    shares even if one partition or one location holds a third of the rows, and
    each file covers a compact area. There are as many tasks as hold ``file_bytes`` each.
    """
    spark = features.sparkSession
    size = partitioner.bytes or total_bytes(features)
    files = files or max(1, -(-size // file_bytes))
    assigned = partitioner.assign(features, home="is_home")
    if "minx" not in assigned.columns:
        assigned = with_envelope(assigned)
    if extent is None:
        corners = features if "minx" in features.columns else with_envelope(features)
        facts = corners.agg(F.min("minx"), F.min("miny"), F.max("maxx"), F.max("maxy")).first()
        extent = Box(*[0.0 if v is None else float(v) for v in facts])
    keyed = assigned.withColumn("_z", z_order(F.col("minx"), F.col("miny"), extent)).withColumn(
        "_spread", F.xxhash64(*[c for c in assigned.columns if c != "part_id"], F.spark_partition_id())
    )
    placed = keyed.repartitionByRange(files, "part_id", "_z", "_spread")
    ordered = placed.sortWithinPartitions("part_id", "_z").drop("_z", "_spread")
    ordered.write.mode(mode).partitionBy("part_id").parquet(f"{path}/features")
    stored = spark.read.schema(ordered.schema).parquet(f"{path}/features")
    write_tree(stored, partitioner.rows, f"{path}/tree", mode)


def write_tree(stored: DataFrame, rows: int, path: str, mode: str = "errorifexists") -> None:
    """The packed tree of a stored index: ``level, node, parent, file, n_features`` and a box per node.

    Level 0 are files, level 1 partitions, level 2 strips of ``rows`` partitions. Only box columns are scanned, and sums
    are merged before they are shuffled; each level is packed from the one below.
    """

    def boxes(frame: DataFrame, *keys: Column | str) -> DataFrame:
        return frame.groupBy(*keys).agg(
            F.sum("n_features").alias("n_features"), F.min("minx").alias("minx"), F.min("miny").alias("miny"),
            F.max("maxx").alias("maxx"), F.max("maxy").alias("maxy"),
        )

    kind = "level int, node bigint, parent bigint, file string, n_features bigint, minx double, miny double, maxx double, maxy double"
    names = [part.split()[0] for part in kind.split(", ")]
    counted = stored.select("part_id", F.col("_metadata.file_path").alias("file"), F.lit(1).cast("bigint").alias("n_features"), *BOX)
    leaves = boxes(counted, "part_id", "file").withColumns(
        {"level": F.lit(0), "node": F.xxhash64("file"), "parent": F.col("part_id").cast("bigint")}
    ).select(*names)
    leaves.write.mode(mode).parquet(f"{path}/level=0")
    spark = stored.sparkSession
    for level in (1, 2):
        below = spark.read.schema(kind).parquet(f"{path}/level={level - 1}").withColumn("level", F.lit(level - 1))
        above = boxes(below, F.col("parent").alias("node")).withColumns(
            {"level": F.lit(level), "parent": F.floor(F.col("node") / rows) if level == 1 else F.lit(0).cast("bigint"),
             "file": F.lit(None).cast("string")}
        ).select(*names)
        above.write.mode(mode).parquet(f"{path}/level={level}")


def read_tree(spark: SparkSession, path: str, box: Box | None = None) -> DataFrame:
    """Files of a stored index (``file, part_id, n_features`` and their boxes), those that meet ``box`` if it is given.

    The tree is descended by joins: strips that meet the box, their partitions that do, their files that do.
    """
    kind = "node bigint, parent bigint, file string, n_features bigint, minx double, miny double, maxx double, maxy double"

    def level(n: int) -> DataFrame:
        nodes = spark.read.schema(kind).parquet(f"{path}/tree/level={n}")
        if box is None:
            return nodes
        return nodes.where(
            (F.col("minx") <= box.maxx) & (F.col("maxx") >= box.minx) & (F.col("miny") <= box.maxy) & (F.col("maxy") >= box.miny)
        )

    found = level(2)
    for n in (1, 0):
        above = found.select(F.col("node").alias("_above"))
        found = level(n).join(above, F.col("parent") == F.col("_above"), "left_semi")
    return found.select("file", F.col("parent").cast("int").alias("part_id"), "n_features", *BOX)


def read_index(
    spark: SparkSession, path: str, box: Box | None = None, copies: bool = False, named_files: int = NAMED_FILES
) -> DataFrame:
    """Read an index back, opening only what meets ``box``.

    Up to ``named_files`` files that the tree leads to are opened by name. If there are more, the partitions that meet the
    box are joined on the partition column, which prunes directories; they are broadcast if they were counted to be few. The
    exact test runs on what is read. Each feature comes once (from its home part, whose box always covers it);
    ``copies`` returns it for every part it lies in.
    """
    features = spark.read.parquet(f"{path}/features")
    if box is not None:
        met = read_tree(spark, path, box)
        named = [r.file for r in met.select("file").limit(named_files + 1).collect()]
        if len(named) <= named_files:
            schema = features.schema
            reader = spark.read.schema(schema).option("basePath", f"{path}/features")
            features = reader.parquet(*named) if named else spark.createDataFrame([], schema)
        else:
            parts = met.select("part_id").distinct()
            few = parts.count() * 16 <= BROADCAST_BYTES
            features = features.join(F.broadcast(parts) if few else parts, "part_id", "left_semi")
        features = range_query(features, box)
    return features if copies else features.where("is_home").drop("is_home")
