"""Near duplicates by SimHash, linked through multi-index hashing.

A 64-bit fingerprint is two segments of 32 bits. Of two fingerprints at 2 or fewer differing bits, either the first
segments differ in at most one bit or the second ones are equal. So the Hamming ball of radius 1 around the first
segment and the second segment itself are looked up in a table per segment, and matches are verified in full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .memory import give_back, returned, small_batches
from .text import row_key, settle, small_enough, without
from .words import word_blocks

SHINGLE, SEED, BITS = 3, 42, 2
# Fingerprints of one key beyond which the key is refined.
CROWDED = 1024


def _fingerprint(text: str | None, size: int) -> int:
    ones, total, tail = np.zeros(64, np.int64), 0, []
    hashed = xxhash.xxh64_intdigest

    def count(pieces) -> int:
        h = np.array([hashed(p, SEED) for p in pieces], dtype="<u8")
        ones[:] += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        return len(h)

    for block in word_blocks(text, lower=True):
        words = tail + block
        runs = zip(*(words[i:] for i in range(size)), strict=False)
        total += count(map(b" ".join, runs)) if len(words) >= size else 0
        tail = words[-(size - 1) :] if size > 1 else []
    if not total:
        if not tail:
            return 0
        total = count([b" ".join(tail)])
    bits = np.packbits(2 * ones > total, bitorder="little").view("<i8")
    return int(bits[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """``id, print`` per row: bit i is set if over half of the shingle hashes have it; no words give 0."""

    @returned
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        for b in batches:
            prints = [_fingerprint(t.as_py(), size) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(prints, pa.int64())], ["id", "print"])

    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, print bigint")


def links(prints: DataFrame, bits: int = BITS, most: int = CROWDED) -> DataFrame:
    """Pairs ``a < b`` of different fingerprints (column ``print``, distinct) at 2 or fewer differing bits.

    A key that more than ``most`` fingerprints share is refined by the halves of the other segment, so that a large
    group of near copies meets in many small tables instead of one.
    """
    if bits != BITS:
        raise ValueError("segments and radii are laid out for 2 bits")
    high, low = F.shiftrightunsigned("print", 32), F.col("print").bitwiseAND(0xFFFFFFFF)

    def key(segment: int, value: Column, other: Column) -> Column:
        return F.struct(F.lit(segment).alias("segment"), value.alias("value"), other.alias("other"))

    ball = [high.bitwiseXOR(m) for m in (0, *(1 << i for i in range(32)))]
    table = prints.select("print", F.inline(F.array(key(0, high, low), key(1, low, high))))
    probes = prints.select("print", F.inline(F.array(*[key(0, v, low) for v in ball], key(1, low, high))))
    crowded = table.groupBy("segment", "value").agg(F.count("*").alias("n")).where(F.col("n") > most).drop("n")
    crowded = settle(crowded.withColumn("split", F.lit(True)), "simhash-crowded")
    table, probes = (_refine(x, crowded, r) for x, r in ((table, 0), (probes, 1)))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits
    pairs = probes.withColumnRenamed("print", "a").join(
        table.withColumnRenamed("print", "b"), ["segment", "value", "half", "part"]
    )
    return pairs.where((F.col("a") < F.col("b")) & near).select("a", "b").distinct()


def _refine(rows: DataFrame, crowded: DataFrame, radius: int) -> DataFrame:
    """Give rows of crowded keys a second key: the ball around the first half of the other segment, and its second half.

    Two fingerprints that meet at a key differ in at most 2 bits of the other segment, so the argument for the
    segments holds for its halves too.
    """
    if crowded.isEmpty():
        return rows.select("print", "segment", "value", F.lit(-1).alias("half"), F.lit(0).cast("long").alias("part"))
    few = small_enough(crowded, 24)
    rows = rows.join(F.broadcast(crowded) if few else crowded, ["segment", "value"], "left")
    first, second = F.shiftrightunsigned("other", 16), F.col("other").bitwiseAND(0xFFFF)
    masks = [0, *(1 << i for i in range(16))] if radius else [0]

    def part(half: int, value: Column) -> Column:
        return F.struct(F.lit(half).alias("half"), value.cast("long").alias("part"))

    parts = F.array(*[part(0, first.bitwiseXOR(m)) for m in masks], part(1, second))
    parts = F.when(F.col("split"), parts).otherwise(F.array(part(-1, F.lit(0))))
    return rows.select("print", "segment", "value", F.inline(parts))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col, fingerprint`` (16 hex digits), ``component_id`` (smallest id reachable).

    Equal fingerprints are one node, so copies are never paired. Null and empty texts have fingerprint zero and link
    like any other. A null id is never the smallest; if a component has no other, its id is null. Repeated rows
    give repeated results; an empty table gives an empty result; further columns are ignored.
    """
    prints = settle(fingerprints(docs, id_col, text_col), "simhash-prints")
    nodes = settle(prints.groupBy("print").agg(F.min("id").alias("first")), "simhash-nodes")
    roots = settle(components(links(nodes)).withColumnRenamed("node", "print"), "simhash-roots")
    labelled = nodes.join(roots, "print", "left").withColumn("root", F.coalesce("root", "print"))
    smallest = labelled.groupBy("root").agg(F.min("first").alias("component_id"))
    of_print = labelled.join(smallest, "root").select("print", "component_id")
    return prints.join(of_print, "print").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component, with all its columns: the smallest id, null ids last, ties by a hash of the text.

    Rows of equal id and equal text are told apart by nothing and stay or go together.
    """
    rows = docs.select(row_key(id_col, text_col).alias("_key"), F.col(text_col).alias("text"))
    found = near_duplicates(rows, "_key")
    return without(docs, id_col, text_col, found.where(F.col("_key") != F.col("component_id")).select("_key"))
