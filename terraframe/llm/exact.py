"""Exact duplicates by progressive refinement: length, then a hash of the prefix, then a hash of the whole text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import BROADCAST_BYTES, ascii_lower, settle, small_enough, whole

PREFIX_CHARS = 256


def duplicate_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = PREFIX_CHARS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Groups of two or more equal texts: ``text_sha256, keep_id, group_size, n_top``.

    Each step counts only what the step before left together, and only the last one hashes whole texts. All
    counts are aggregated before they are shuffled, so a group with a third of all rows is one row per task. The
    keys left by a step are broadcast if they are few (counted), else joined by a shuffle of keys and hashes; no
    text is shuffled either way. ``n_top`` is the number of rows that carry ``keep_id``.
    """
    rows = docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text"))
    rows = rows.select("id", "text", F.octet_length("text").alias("len"))
    lengths = settle(_repeated(rows.select("len"), ["len"]), "dedup-lengths")
    few = small_enough(lengths, 16, broadcast_bytes)
    start = rows.select("len", F.xxhash64(ascii_lower(F.substring("text", 1, prefix))).alias("head"))
    prefixes = settle(_repeated(_within(start, lengths, ["len"], few), ["len", "head"]), "dedup-prefixes")
    few = small_enough(prefixes, 24, broadcast_bytes)
    headed = rows.select("id", "text", "len", F.xxhash64(ascii_lower(F.substring("text", 1, prefix))).alias("head"))
    sha = F.sha2(ascii_lower(F.col("text")), 256).alias("text_sha256")
    if few:
        full = _within(headed, prefixes, ["len", "head"], True).select("id", sha)
    else:  # hash first, so that hashes and not texts are shuffled
        full = _within(headed.select("id", "len", "head", sha), prefixes, ["len", "head"], False)
    by_id = full.groupBy("text_sha256", "id").agg(F.count("*").alias("n"))
    return (
        by_id.groupBy("text_sha256")
        .agg(F.max("id").alias("keep_id"), F.sum("n").alias("group_size"), F.max_by("n", F.struct(F.col("id").isNotNull(), "id")).alias("n_top"))
        .where("group_size > 1")
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: ``id_col, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z; a null text counts as empty. The row with the largest id
    stays; a null id is smaller than any other. Of repeated rows with the same id exactly one stays. An empty
    table gives an empty result; further columns are ignored.
    """
    groups = settle(duplicate_groups(docs, id_col, text_col, **options), "dedup-groups")
    rows = docs.select(
        F.col(id_col).alias("id"), F.sha2(ascii_lower(whole(text_col)), 256).alias("text_sha256")
    )
    joined = rows.join(groups, "text_sha256", "left")
    top = F.col("group_size").isNotNull() & F.col("id").eqNullSafe(F.col("keep_id"))
    out = [
        F.col("id").alias(id_col),
        F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
    ]
    single = joined.where(~(top & (F.col("n_top") > 1))).select(
        *out, (F.col("group_size").isNull() | top).alias("kept"), "text_sha256"
    )
    # Repeated rows with the id that stays: as many rows as there were, the first one kept.
    tied = groups.where("n_top > 1").select(
        "*", F.col("keep_id").alias("id"), F.explode(F.sequence(F.lit(1), F.col("n_top").cast("int"))).alias("nth")
    )
    return single.unionByName(tied.select(*out, (F.col("nth") == 1).alias("kept"), "text_sha256"))


def drop_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", broadcast_bytes: int = BROADCAST_BYTES, **options
) -> DataFrame:
    """The documents that stay, with all their columns; texts move only if the groups are too many to broadcast."""
    groups = settle(
        duplicate_groups(docs, id_col, text_col, broadcast_bytes=broadcast_bytes, **options), "dedup-groups"
    )
    rows = docs.select(
        F.struct("*").alias("row"), F.col(id_col).alias("id"), F.sha2(ascii_lower(whole(text_col)), 256).alias("text_sha256")
    )
    few = small_enough(groups, 128, broadcast_bytes)
    joined = rows.join(F.broadcast(groups) if few else groups, "text_sha256", "left")
    joined = joined.where(F.col("group_size").isNull() | F.col("id").eqNullSafe(F.col("keep_id")))
    tied = joined.where("n_top > 1").groupBy("text_sha256").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return joined.where("coalesce(n_top, 1) = 1").select("row.*").unionByName(tied.select("row.*"))


def _repeated(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").drop("n")


def _within(rows: DataFrame, keys: DataFrame, on: list[str], few: bool) -> DataFrame:
    return rows.join(F.broadcast(keys) if few else keys, on, "left_semi")
