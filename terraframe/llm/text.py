"""What the operators of this package share: input tables, ASCII case, written intermediate tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A table is broadcast only below this many bytes, counted before.
BROADCAST_BYTES = 64 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole(text: str | Column) -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and nothing else; the common all-ASCII text takes the quick way."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def settle(frame: DataFrame, purpose: str) -> DataFrame:
    """Write a frame into the shared folder and read it: lineage ends there, and lost executors lose nothing."""
    spark = frame.sparkSession
    path = shared_folder(spark, purpose)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def small_enough(frame: DataFrame, bytes_per_row: int, limit: int = BROADCAST_BYTES) -> bool:
    """Whether a settled frame of fixed-width rows may be broadcast."""
    return frame.count() * bytes_per_row <= limit


def row_key(id_col: str, text_col: str) -> Column:
    """What a row is told apart by: its id, null ids last in order, and a hash of its text."""
    return F.struct(F.col(id_col).isNull().alias("unknown"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("of"))


def without(docs: DataFrame, id_col: str, text_col: str, dropped: DataFrame) -> DataFrame:
    """The rows whose key (``row_key``) is not among ``dropped`` (one column); null ids are ids like any other.

    The keys are broadcast if they are few, so that no text moves; else both sides are shuffled.
    """
    keys = dropped.toDF("_dropped").select(F.col("_dropped.id").alias("_id"), F.col("_dropped.of").alias("_of")).distinct()
    keys = settle(keys, "dropped-rows")
    keys = F.broadcast(keys) if small_enough(keys, 24) else keys
    same = docs[id_col].eqNullSafe(keys["_id"]) & (F.xxhash64(docs[text_col]) == keys["_of"])
    return docs.join(keys, same, "left_anti")
