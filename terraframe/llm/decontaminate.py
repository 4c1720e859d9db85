"""Benchmark decontamination: short test items searched in whole documents by MinHash containment.

An item is contained if at least ``threshold`` of its distinct word shingles occur in the document. Items are
partitioned by their number of shingles; each class fixes how many of an item's smallest hashes (its bottom-k MinHash
sketch) make up the item's probes: one more than the shingles that an item of the class may miss. So a document that
contains an item has at least one of its probes, whatever the length of the document, and no item is overlooked.
Documents are scanned whole against the index of probes, and candidates are verified on the shingles themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .memory import give_back, returned, small_batches
from .text import row_key, settle, whole, without
from .words import WordHashes, shingles, word_blocks

SHINGLE, THRESHOLD = 5, 0.8
# Items are held by tasks in blocks of about this many bytes of text; documents are scanned once per block.
BLOCK_BYTES = 32 << 20
_FILTER_BITS = 20


def probes_of_class(size: int, threshold: float) -> int:
    """Probes of an item with this many shingles, by the upper bound of its size class (a power of two)."""
    upper = 1 << max(0, size - 1).bit_length()
    return min(size, upper - ceil(threshold * upper - 1e-9) + 1)


def _real_shingles(text: str | None, k: int) -> set[tuple[bytes, ...]]:
    words = [w for block in word_blocks(text, lower=True) for w in block]
    k = min(k, len(words))
    return set(zip(*(words[i:] for i in range(k)), strict=False)) if k else set()


class _Index:
    """Probe hashes of a block of items, and the items' own shingles."""

    def __init__(self, items: list[tuple[object, str]], k: int, threshold: float) -> None:
        hashes, probes, owners = WordHashes(), [], []
        self.ids, self.real = [i for i, _ in items], [_real_shingles(t, k) for _, t in items]
        for number, (_, text) in enumerate(items):
            own = np.unique(shingles(hashes.of(text, True), k))
            take = own[: probes_of_class(len(own), threshold)] if len(own) else own
            probes.append(take)
            owners.append(np.full(len(take), number))
        probes, owners = (np.concatenate(x) if x else np.empty(0, int) for x in (probes, owners))
        order = np.argsort(probes, kind="stable")
        self.probes, self.owners = probes[order].astype(np.uint64), owners[order]
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[(self.probes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True

    def candidates(self, own: np.ndarray) -> np.ndarray:
        own = own[self.filter[(own >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)]]
        low, high = np.searchsorted(self.probes, own), np.searchsorted(self.probes, own, "right")
        found = [self.owners[a:b] for a, b in zip(low[high > low], high[high > low], strict=True)]
        return np.unique(np.concatenate(found)) if found else np.empty(0, int)


def contained_items(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", size: int = SHINGLE, threshold: float = THRESHOLD, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Pairs ``id_col, item_col, shared, item_shingles, containment`` with containment at ``threshold`` or above.

    Words are runs of other than ASCII white space, A-Z in lower case; a text of fewer than ``size`` words is one
    shingle. A null or empty text has no shingles: such an item is in no document, such a document holds none. A
    null id is reported as null; repeated documents or items give repeated pairs; an empty table on either side
    gives an empty result; further columns are ignored.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    items = benchmark.select(F.col(item_col).alias("item"), whole(item_text_col).alias("text"))
    items = settle(items, "benchmark-items")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, ceil(total / block_bytes))
    in_block = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    kinds = [f.dataType.simpleString() for f in (rows.schema["id"], items.schema["item"])]
    schema = f"id {kinds[0]}, item {kinds[1]}, shared bigint, item_shingles bigint, containment double"
    found = None
    for n in range(blocks):
        held = [tuple(r) for r in items.where(in_block == n).collect()]
        part = rows.mapInArrow(_search(rows.sparkSession.sparkContext.broadcast(held), size, threshold), schema)
        found = part if found is None else found.unionByName(part)
    return found.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "shared", "item_shingles", "containment")


def _search(held, size: int, threshold: float):
    @returned
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        index, hashes, kind = _Index(held.value, size, threshold), WordHashes(), None
        for b in batches:
            rows: list[tuple] = []
            for number, text in enumerate(b.column(1)):
                text = text.as_py()
                candidates = index.candidates(shingles(hashes.of(text, True), size))
                if not len(candidates):
                    continue
                own = _real_shingles(text, size)
                for c in candidates:
                    shared, of = len(index.real[c] & own), len(index.real[c])
                    if shared / of >= threshold:
                        rows.append((number, index.ids[c], shared, of, shared / of))
            at, item, shared, of, share = zip(*rows, strict=True) if rows else ((),) * 5
            kind = pa.array([i for i in index.ids], None).type if index.ids else pa.int64()
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(at, pa.int64())), pa.array(item, kind), pa.array(shared, pa.int64()),
                 pa.array(of, pa.int64()), pa.array(share, pa.float64())],
                ["id", "item", "shared", "item_shingles", "containment"],
            )

    return run


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """The documents that contain no benchmark item, with all their columns; each row is judged by its own text."""
    rows = docs.select(row_key(id_col, text_col).alias("_key"), F.col(text_col).alias("text"))
    return without(docs, id_col, text_col, contained_items(rows, benchmark, "_key", **options).select("_key"))
