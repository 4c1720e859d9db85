"""Shards of nearly equal bytes: a minimax contiguous partition of ordered atomic groups of equal texts."""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .text import settle, whole

ROW_BYTES = 16
FIRST_BITS, STEP_BITS = 16, 4
# Rows of a shard are numbered in this many cells at once.
CELLS = 4096


class Atom(NamedTuple):
    """Groups whose hashes share their first bits; ``low == high`` when it is one group that cannot be cut."""

    bits: int
    key: int
    size: int
    low: int
    high: int

    @property
    def divisible(self) -> bool:
        return self.low != self.high


def minimax_shards(
    docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text", cells: int = CELLS
) -> DataFrame:
    """One row per document: ``id_col, size, text_crc32, shard, slot``.

    The size of a row is the UTF-8 bytes of its text (null: none) plus 16. Equal texts form an atomic group; groups
    are ordered by the hash of their text and cut into contiguous shards of the smallest feasible capacity.
    A group above the mean of what is left gets a shard of its own. Slots count from 0 in each shard without
    gaps, in the order of (cell of the id, id). Null and empty texts are one group. A null id counts as an id.
    An empty table gives an empty result; further columns are ignored.

    Only sums over hash prefixes reach the driver: first 2**16, then finer ones where a cut can still fall,
    until every cut lies between single groups. Documents then find their shard by comparing hashes.
    """
    rows = settle(
        docs.select(
            F.col(id_col).alias("id"),
            (F.octet_length(whole(text_col)).cast("long") + ROW_BYTES).alias("size"),
            F.crc32(whole(text_col).cast("binary")).alias("text_crc32"),
            F.xxhash64(whole(text_col)).alias("h"),
        ),
        "shard-rows",
    )
    cuts, large = plan_cuts(rows, shards)
    placed = rows.withColumn("shard", _shard(cuts, large, shards))
    placed = placed.withColumn("cell", F.pmod(F.xxhash64("id", "text_crc32"), F.lit(cells)).cast("int"))
    # At most shards * cells rows, so its size is bounded and it may be broadcast.
    counts = placed.groupBy("shard", "cell").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    nth = F.row_number().over(Window.partitionBy("shard", "cell").orderBy("id", "text_crc32", "size"))
    numbered = placed.withColumn("nth", nth).join(F.broadcast(first), ["shard", "cell"])
    return numbered.select(
        F.col("id").alias(id_col), "size", "text_crc32", "shard", (F.col("first") + F.col("nth") - 1).alias("slot")
    )


def _shard(cuts: list[int], large: list[int], shards: int) -> Column:
    """Large groups have the last shards; the others count the cuts at or below their hash, in unsigned order."""
    order = F.col("h").bitwiseXOR(F.lit(-(1 << 63)))
    place = sum(((order >= F.lit(c - (1 << 63))).cast("int") for c in cuts), F.lit(0))
    for i, h in enumerate(large):
        place = F.when(F.col("h") == F.lit(h), F.lit(shards - 1 - i)).otherwise(place)
    return place.cast("int")


def plan_cuts(rows: DataFrame, shards: int) -> tuple[list[int], list[int]]:
    """Cut points in unsigned hash order, and the hashes of groups that have a shard of their own."""
    atoms = _atoms(rows, FIRST_BITS, None)
    while True:
        rest, large, left = set_apart(atoms, shards)
        prefix = [0, *accumulate(a.size for a in rest)]
        mean = prefix[-1] / left
        split = {(a.bits, a.key) for a in rest if a.divisible and a.size > mean} | (
            {(a.bits, a.key) for a in open_atoms(rest, prefix, left)}
        )
        if not split:
            cuts = even_cuts(prefix, capacity(prefix, left), left)
            starts = [rest[i].key << (64 - rest[i].bits) for i in cuts if i < len(rest)]
            return starts, [a.low for a in large]
        finer = [
            x for bits in sorted({b for b, _ in split})
            for x in _atoms(rows, min(64, bits + STEP_BITS), _ranges(sorted(k for b, k in split if b == bits), bits))
        ]
        atoms = sorted([a for a in atoms if (a.bits, a.key) not in split] + finer, key=lambda a: a.key << (64 - a.bits))


def _ranges(keys: list[int], bits: int) -> list[tuple[int, int, int]]:
    """Runs of neighbouring prefixes as (bits, first, last)."""
    runs: list[list[int]] = []
    for k in keys:
        if runs and runs[-1][1] == k - 1:
            runs[-1][1] = k
        else:
            runs.append([k, k])
    return [(bits, a, b) for a, b in runs]


def _prefix(bits: int) -> Column:
    return F.shiftrightunsigned("h", 64 - bits) if bits < 64 else F.col("h")


def _atoms(rows: DataFrame, bits: int, ranges: list[tuple[int, int, int]] | None) -> list[Atom]:
    if ranges is not None:
        spark, lists = rows.sparkSession, [(a, b) for _, a, b in ranges]
        inside = F.lit(False)
        for a, b in lists if len(lists) <= 200 else []:
            inside = inside | _prefix(ranges[0][0]).between(a, b)
        if len(lists) > 200:  # many single prefixes: a bounded list, joined instead of written out
            keys = spark.createDataFrame([(k,) for a, b in lists for k in range(a, b + 1)], "k long")
            rows = rows.join(F.broadcast(keys), _prefix(ranges[0][0]) == F.col("k"), "left_semi")
        else:
            rows = rows.where(inside)
    sums = rows.groupBy(_prefix(bits).alias("k")).agg(
        F.sum("size").alias("size"), F.min("h").alias("low"), F.max("h").alias("high")
    )
    return sorted((Atom(bits, r.k % (1 << 64), r.size, r.low, r.high) for r in sums.collect()), key=lambda a: a.key)


def set_apart(atoms: list[Atom], shards: int) -> tuple[list[Atom], list[Atom], int]:
    """Single groups above the mean of the rest get a shard each; returns the rest, them, and the shards left."""
    rest, large, total = list(atoms), [], sum(a.size for a in atoms)
    for a in sorted((a for a in atoms if not a.divisible), key=lambda a: (-a.size, a.key)):
        if shards - len(large) < 2 or a.size * (shards - len(large)) <= total:
            break
        large.append(a)
        rest.remove(a)
        total -= a.size
    return rest, large, shards - len(large)


def greedy(prefix: list[int], most: int, shards: int) -> list[int] | None:
    """Atom numbers at which the shards after the first begin, each filled up to ``most``; None if it can't be done."""
    cuts, i, n = [], 0, len(prefix) - 1
    for _ in range(shards):
        j = bisect_right(prefix, prefix[i] + most) - 1
        if j == n:
            return cuts
        if j == i:
            return None
        cuts.append(i := j)
    return None


def even_cuts(prefix: list[int], most: int, shards: int) -> list[int]:
    """Cuts under a feasible capacity for which the smallest shard is as large as can be.

    The greedy check fills every shard and leaves the last one short, so a second binary search looks for the
    largest floor for which some partition keeps all sizes between floor and capacity.
    """
    ends = np.array(prefix, dtype=np.int64)

    def within(least: int) -> list[np.ndarray] | None:
        """For each number of shards, at which atoms a partition with these sizes can end."""
        start = np.searchsorted(ends, ends - most)
        stop = np.searchsorted(ends, ends - least, "right")
        reach = [np.arange(len(ends)) == 0]
        for _ in range(shards):
            seen = np.concatenate([[0], np.cumsum(reach[-1])])
            reach.append(seen[np.maximum(stop, start)] > seen[start])
        return reach if reach[-1][-1] else None

    low, high = 0, prefix[-1] // shards
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if within(middle) else (low, middle - 1)
    reach, cuts, at = within(low) or [], [], len(prefix) - 1
    for reached in reversed(reach[1:-1]):
        fits = np.flatnonzero(reached & (ends >= ends[at] - most) & (ends <= ends[at] - low))
        at = int(fits[np.argmin(np.abs(ends[fits] - ends[at] + prefix[-1] / shards))])
        cuts.append(at)
    return cuts[::-1]


def capacity(prefix: list[int], shards: int) -> int:
    """The smallest capacity for which the greedy check succeeds."""
    low, high = -(-prefix[-1] // shards), prefix[-1]
    while low < high:
        middle = (low + high) // 2
        low, high = (middle + 1, high) if greedy(prefix, middle, shards) is None else (low, middle)
    return low


def _fluid(atoms: list[Atom], prefix: list[int], most: int, shards: int) -> list[int] | None:
    """As greedy, but divisible atoms may be cut anywhere; positions instead of atom numbers."""
    cuts, at = [], 0
    for _ in range(shards):
        to = at + most
        if to >= prefix[-1]:
            return cuts
        j = bisect_right(prefix, to) - 1
        to = to if atoms[j].divisible else prefix[j]
        if to <= at:
            return None
        cuts.append(at := to)
    return None


def open_atoms(atoms: list[Atom], prefix: list[int], shards: int) -> list[Atom]:
    """Divisible atoms in which a cut of the best partition may fall."""
    if not any(a.divisible for a in atoms):
        return []
    high = capacity(prefix, shards)
    low, top = -(-prefix[-1] // shards), high
    while low < top:
        middle = (low + top) // 2
        low, top = (middle + 1, top) if _fluid(atoms, prefix, middle, shards) is None else (low, middle)
    furthest = _fluid(atoms, prefix, high, shards) or []
    found, at = set(), 0
    for end in [*furthest, *[prefix[-1]] * (shards - 1 - len(furthest))]:
        at = max(at, prefix[min(bisect_right(prefix, at + low) - 1, len(atoms))])
        first = max(0, bisect_right(prefix, at) - 1)
        last = min(len(atoms) - 1, bisect_right(prefix, end) - 1)
        found.update(i for i in range(first, last + 1) if atoms[i].divisible)
    return [atoms[i] for i in sorted(found)]
