"""Packing documents into sequences by minimum bin slack.

What has to be packed is a histogram of piece lengths, at most one entry per length, whatever the size of the corpus. The
longest length left opens a window; a subset-sum program over a bitset finds the multiset of remaining lengths that
comes closest to filling it, and the pattern is repeated as often as the remaining counts allow. Pieces then find
their places by their rank among the pieces of their length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .memory import give_back, returned, small_batches
from .text import settle
from .tokens import Encoder

SEQUENCE, END_ID = 2048, 1
# Pieces of one length are numbered in this many cells at once.
CELLS = 1024


class Pattern(NamedTuple):
    """``times`` sequences that each hold, in this order, ``count`` pieces of ``length``."""

    first: int
    times: int
    content: list[tuple[int, int]]


def best_fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of lengths, within their counts, whose sum comes closest to ``room`` from below.

    Lengths are taken from the longest down, in multiples of powers of two; bit s of the set is on if sum s can be
    reached. The sets before each step lead back to the multiset.
    """
    steps, reach, wanted, within = [], 1, 1 << room, (1 << (room + 1)) - 1
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, times = min(counts[length], room // length), 1
        while left and not reach & wanted:
            times = min(times, left)
            steps.append((length, times, reach))
            reach |= reach << length * times & within
            left, times = left - times, 2 * times
        if reach & wanted:
            break
    total, used = reach.bit_length() - 1, {}
    for length, times, before in reversed(steps):
        if not before >> total & 1:
            total -= length * times
            used[length] = used.get(length, 0) + times
    return used


def plan(histogram: dict[int, int], sequence: int = SEQUENCE) -> list[Pattern]:
    """Patterns that use up the histogram."""
    left, patterns, first = {x: n for x, n in histogram.items() if n}, [], 0
    while left:
        longest = max(left)
        rest = left | {longest: left[longest] - 1}
        used = best_fill({x: n for x, n in rest.items() if n}, sequence - longest)
        used[longest] = used.get(longest, 0) + 1
        times = min(left[x] // n for x, n in used.items())
        patterns.append(Pattern(first, times, sorted(used.items(), reverse=True)))
        first += times
        for x, n in used.items():
            left[x] -= n * times
            if not left[x]:
                del left[x]
    return patterns


def pieces(docs: DataFrame, tokenizer: str, id_col: str, text_col: str, sequence: int, end_id: int) -> DataFrame:
    """Documents cut into full sequences and a rest: ``id, start, length, ids_crc32, doc_tokens``."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    @returned
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        encoder, end = Encoder(tokenizer, kept=False), np.array([end_id], "<u4").tobytes()
        for b in batches:
            out: list[tuple[int, int, int, int, int]] = []
            for number, own in enumerate(encoder.each(text.as_py() for text in b.column(1))):
                ids = own + end
                total = len(ids) // 4
                for start in range(0, total, sequence):
                    part = memoryview(ids)[4 * start : 4 * (start + sequence)]
                    out.append((number, start, len(part) // 4, zlib.crc32(part), total))
            at, *values = (pa.array(v, pa.int64()) for v in (zip(*out, strict=True) if out else [()] * 5))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(at), *values], ["id", "start", "length", "ids_crc32", "doc_tokens"]
            )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint")


def _places(patterns: list[Pattern]) -> dict[int, np.ndarray]:
    """Per length the columns (first rank, first sequence, pieces per sequence, first offset), in order of rank."""
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    taken: dict[int, int] = {}
    for p in patterns:
        offset = 0
        for length, n in p.content:
            rows.setdefault(length, []).append((taken.get(length, 0), p.first, n, offset))
            taken[length] = taken.get(length, 0) + n * p.times
            offset += n * length
    return {length: np.array(r, np.int64).T for length, r in rows.items()}


def pack_documents(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", sequence: int = SEQUENCE,
    end_id: int = END_ID, cells: int = CELLS,
) -> DataFrame:
    """One row per piece: ``id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    A document is the ids of its text and the end id, cut into full sequences and a rest; a null or empty text is the end
    id alone. Sequences are numbered from 0 and pieces lie in them without gaps. A null id is kept; repeated rows are
    repeated documents; an empty table gives an empty result; further columns are ignored.
    """
    cut = settle(pieces(docs, tokenizer, id_col, text_col, sequence, end_id), "packing-pieces")
    cut = cut.withColumn("cell", F.pmod(F.xxhash64("id", "start", "ids_crc32"), F.lit(cells)).cast("int"))
    counts = settle(cut.groupBy("length", "cell").agg(F.count("*").alias("n")), "packing-counts")
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = _places(plan(histogram, sequence))
    # Ranks: within a cell, after the cells before it. No cell holds more than its share of a length.
    before = Window.partitionBy("length").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("length", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    nth = F.row_number().over(Window.partitionBy("length", "cell").orderBy("id", "start", "ids_crc32"))
    ranked = cut.withColumn("nth", nth).join(first, ["length", "cell"]).select(
        "id", "start", "length", "ids_crc32", "doc_tokens", (F.col("first") + F.col("nth") - 1).alias("rank")
    )

    @returned
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = (b.column(i).to_numpy(zero_copy_only=False) for i in (2, 5))
            out = np.empty((2, len(length)), np.int64)
            for x in np.unique(length):
                own = length == x
                table = places[int(x)]
                row = np.searchsorted(table[0], rank[own], "right") - 1
                nth, (_, seq, n, offset) = rank[own] - table[0][row], table[:, row]
                out[:, own] = seq + nth // n, offset + nth % n * x
            arrays = [*b.columns[:5], pa.array(out[0]), pa.array(out[1])]
            yield pa.RecordBatch.from_arrays(arrays, [*b.schema.names[:5], "sequence_id", "offset"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema.fields[:5])
    packed = ranked.mapInArrow(place, f"{kinds}, sequence_id bigint, offset bigint")
    return packed.withColumnRenamed("id", id_col)
