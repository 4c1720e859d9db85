"""Ranked lexical search without a document index: an automaton of all item terms reads the documents.

Every term stands in an Aho-Corasick automaton between two boundary marks, and texts are read with everything between
their terms turned into such marks, so only whole terms match and all of them are found in one pass. A term leads to
its number, the number to the items that ask for it. Documents are scored in blocks against the items of their terms
alone, and a task keeps no more than the best of each item.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .license import split_words
from .text import settle

TOP = 50
# Items are searched in blocks of about this many bytes of terms; documents are read once per block.
BLOCK_BYTES = 4 << 20
# Fixed values of the score: its unit, the rise of a repeated term, and how far lengths count, of 100.
UNIT, RISE, SLOPE = 1_000_000_000, 1000, 50
_BUCKETS, _SCORED, _KEPT = 64, 256, 4
# Bytes that stand between terms become blanks, A-Z lower case; bytes of other characters stay.
_MARKS = bytes(
    i + 32 if 65 <= i <= 90 else i if 48 <= i <= 57 or 97 <= i <= 122 or i >= 128 else 32 for i in range(256)
)


def marked(text: str | None) -> str:
    """The terms of a text between single or several blanks, with a blank at either end."""
    return f" {(text or '').encode().translate(_MARKS).decode()} "


def automaton(terms: list[str]) -> ahocorasick.Automaton:
    """An automaton that reports the position of a term in the list wherever the whole term stands in a marked text."""
    found = ahocorasick.Automaton()
    for number, term in enumerate(terms):
        found.add_word(f" {term} ", number)
    found.make_automaton()
    return found


def _n_terms(text: str) -> int:
    inside = np.frombuffer(text.encode(), np.uint8) != 32
    return int(np.count_nonzero(inside[1:] & ~inside[:-1]))


def term_counts(rows: DataFrame, terms: Broadcast) -> DataFrame:
    """``id, n, terms, counts`` per row of ``id, text``: its number of terms, and which item terms it has how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = automaton(terms.value).iter if terms.value else lambda _: ()
        for b in batches:
            sizes, found = [], []
            for text in b.column(1):
                text = marked(text.as_py())
                sizes.append(_n_terms(text))
                found.append(Counter([number for _, number in scan(text)]))
            ends = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
            numbers = pa.array([t for c in found for t in c], pa.int32())
            counts = pa.array([n for c in found for n in c.values()], pa.int64())
            columns = [b.column(0), pa.array(sizes, pa.int64())]
            columns += [pa.ListArray.from_arrays(ends, x) for x in (numbers, counts)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n", "terms", "counts"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n bigint, terms array<int>, counts array<bigint>")


class _Scorer:
    """Scores of documents for the items of a block, in 64-bit integers."""

    def __init__(self, weights: np.ndarray, starts: np.ndarray, items: np.ndarray, n_items: int, docs: int, length: int) -> None:
        self._weights, self._starts, self._items, self.n_items = weights, starts, items, n_items
        self._docs, self._length = docs, length

    def scores(self, sizes: list[int], ends: np.ndarray, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """One row per document, one column per item."""
        m = np.array([100 - SLOPE + (SLOPE * n * self._docs) // self._length for n in sizes], np.int64)
        doc = np.repeat(np.arange(len(sizes)), np.diff(ends))
        own = self._weights[terms] * ((UNIT * counts) // (RISE * counts + 20 * m[doc]))
        first, wide = self._starts[terms], np.diff(self._starts)[terms]
        # All items of all terms: positions in the postings run on within a term and jump between terms.
        at = np.arange(wide.sum()) + np.repeat(first - np.cumsum(wide) + wide, wide)
        total = np.zeros(len(sizes) * self.n_items, np.int64)
        np.add.at(total, np.repeat(doc, wide) * self.n_items + self._items[at], np.repeat(own, wide))
        return total.reshape(len(sizes), self.n_items)


class _Best:
    """The best of each item among the documents seen, ties by ascending id, null ids last."""

    def __init__(self, n_items: int, top: int) -> None:
        self._top, self.rows = top, [[] for _ in range(n_items)]
        self._least = np.ones(n_items, np.int64)  # scores below are out

    def add(self, ids: list, scores: np.ndarray) -> None:
        least = self._least
        if len(ids) > self._top:
            least = np.maximum(least, np.partition(scores, len(ids) - self._top, axis=0)[len(ids) - self._top])
        for doc, item in zip(*(x.tolist() for x in np.nonzero(scores >= least)), strict=True):
            found = self.rows[item]
            found.append((-int(scores[doc, item]), ids[doc] is None, ids[doc]))
            if len(found) >= _KEPT * self._top:
                self._cut(item)

    def _cut(self, item: int) -> None:
        found = self.rows[item]
        found.sort(key=lambda r: r[:2] if r[1] else r)
        del found[self._top :]
        if len(found) == self._top:
            self._least[item] = -found[-1][0]

    def finish(self) -> Iterator[tuple[int, int, object]]:
        for item, found in enumerate(self.rows):
            self._cut(item)
            yield from ((item, -score, id_) for score, _, id_ in found)


def _best(counted: DataFrame, scorer: Broadcast, top: int) -> DataFrame:
    """``item, score, id``: the best of every task."""
    kind = counted.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, best, id_kind = _Scorer(*scorer.value), None, None
        for b in batches:
            best, id_kind = best or _Best(own.n_items, top), b.schema.field(0).type
            for at in range(0, b.num_rows, _SCORED):
                part = b.slice(at, _SCORED)
                terms, counts = part.column(2), part.column(3)
                ends = terms.offsets.to_numpy()
                scores = own.scores(
                    part.column(1).to_pylist(), ends - ends[0], terms.flatten().to_numpy(), counts.flatten().to_numpy()
                )
                best.add(part.column(0).to_pylist(), scores)
        if best:
            item, score, id_ = zip(*found, strict=True) if (found := list(best.finish())) else ((),) * 3
            columns = [pa.array(item, pa.int32()), pa.array(score, pa.int64()), pa.array(id_, id_kind)]
            yield pa.RecordBatch.from_arrays(columns, ["item", "score", "id"])

    return counted.mapInArrow(run, f"item int, score bigint, id {kind}")


def _ranked(rows: DataFrame, by: list[str], top: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def rank_documents(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", top: int = TOP, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The ``top`` documents of each item with a score above 0: ``item_col, rank, id_col, score``.

    Terms are runs of digits, letters A-Z without regard to case, and characters beyond ASCII. A term's weight falls with
    the number of documents that have it; its part of the score rises with its occurrences, less so in long documents.

    Rows of one item are one item with the terms of all; a null item is an item. Items without terms, and items whose terms no
    document has, give no rows. Null and empty texts have no terms and do not count as documents. Equal scores are
    ranked by ascending id, null ids last; repeated documents are ranked each. An empty table on either side gives an empty
    result; further columns are ignored. Texts of any length are read whole. Items reach tasks in blocks, one after
    another; a single item's terms are never parted, so a block can be as large as the largest item.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    asked = items.select(F.col(item_col).alias("item"), F.explode(split_words(F.col(item_text_col))).alias("term"))
    asked = settle(asked.distinct(), "ranking-terms")
    total = asked.agg(F.coalesce(F.sum(F.octet_length("term") + 16), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(total / block_bytes))
    found = None
    for block in range(blocks):
        pairs = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).toArrow()
        part = _block(spark, rows, pairs, top)
        found = part if found is None else found.unionByName(part)
    return found.select(F.col("item").alias(item_col), F.col("rank").cast("int"), F.col("id").alias(id_col), "score")


def _block(spark, rows: DataFrame, pairs: pa.Table, top: int) -> DataFrame:
    names = pairs.column("item").unique()
    terms, item_of = sorted(pairs.column("term").unique().to_pylist()), {v: i for i, v in enumerate(names.to_pylist())}
    number = {t: i for i, t in enumerate(terms)}
    postings: list[list[int]] = [[] for _ in terms]
    for item, term in zip(pairs.column("item").to_pylist(), pairs.column("term").to_pylist(), strict=True):
        postings[number[term]].append(item_of[item])
    held = spark.sparkContext.broadcast(terms)
    counted = settle(term_counts(rows, held), "ranking-counts")
    held.destroy()
    n_docs, length = counted.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    n_docs_of = np.zeros(len(terms), np.int64)
    frequency = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n")).toArrow()
    n_docs_of[frequency.column("term").to_numpy()] = frequency.column("n").to_numpy()
    weights = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for n in n_docs_of.tolist()]
    starts = np.cumsum([0, *map(len, postings)])
    scorer = spark.sparkContext.broadcast((
        np.array(weights, np.int64), starts, np.array([i for p in postings for i in p], np.int64), len(names),
        n_docs, max(1, length),
    ))
    best = settle(_best(counted.where("size(terms) > 0"), scorer, top), "ranking-best")
    scorer.destroy()
    # First among a share of the documents each, so that no task meets the best of all tasks.
    shares = best.withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(_BUCKETS)))
    ranked = _ranked(_ranked(shares, ["item", "bucket"], top), ["item"], top)
    labels = spark.createDataFrame(pa.table({"number": pa.array(range(len(names)), pa.int32()), "label": names}))
    return ranked.join(F.broadcast(labels), F.col("item") == F.col("number")).select(
        F.col("label").alias("item"), "rank", "id", "score"
    )
