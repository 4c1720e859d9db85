"""Substring dedup with prefix-partitioned suffix trees over words.

Only suffixes that may repeat enter a tree: of every window the k-gram with the smallest hash is its anchor, equal
windows have equal anchors, so a window whose anchor occurs in one document only is not repeated. The remaining suffixes
are split by a prefix of 16 words; where a prefix has more suffixes than a task should hold, by one of 32 words,
then of the whole window, and a prefix of that depth by document. Each group's tree is walked in depth-first order: its
suffixes sorted by the hashes of their prefixes, where neighbours that agree to the depth of the window lie
below one deep internal node. The smallest document below a node keeps its words, the others lose them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import BROADCAST_BYTES, settle, small_enough
from .words import WordHashes, grams, word_blocks

WINDOW = 50
DEPTHS = (16, 32)
# Suffixes of one prefix beyond which it is made longer.
GROUP = 100_000
_EMIT = 1 << 16


def _anchors(own: np.ndarray, span: int) -> np.ndarray:
    """For each window of ``span`` k-grams the position of its smallest hash, the leftmost of equal ones."""
    out = np.empty(max(0, len(own) - span + 1), np.int64)
    for at in range(0, len(out), _EMIT):
        part = np.lib.stride_tricks.sliding_window_view(own[at : at + _EMIT + span - 1], span)
        out[at : at + len(part)] = np.arange(at, at + len(part)) + part.argmin(axis=1)
    return out


def _sketch(window: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            sizes, shas, keys, found = [], [], [], []
            for text in b.column(1):
                text, digest, n = text.as_py(), hashlib.sha256(), 0
                for words in word_blocks(text, lower=False):
                    digest.update((b" " if n else b"") + b" ".join(words) if words else b"")
                    n += len(words)
                own = grams(hashes.of(text, False), k) if n >= window else np.empty(0, np.uint64)
                found.append(np.unique(own[_anchors(own, window - k + 1)]).view(np.int64))
                sizes.append(n)
                shas.append(digest.hexdigest())
                keys.append(int.from_bytes(digest.digest()[:8], "big", signed=True))
            ends = np.cumsum([0, *map(len, found)])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(found)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()), pa.array(shas, pa.string()), lists],
                ["id", "key", "n_words", "sha", "grams"],
            )

    return run


def _suffixes(window: int, depths: tuple[int, ...]):
    """Suffixes whose anchor is among the repeated grams of the row, with the hashes of their prefixes."""
    k = depths[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            for row in range(len(b)):
                words = hashes.of(b.column(2)[row].as_py(), False)
                own = grams(words, k)
                repeated = np.array(b.column(3)[row].as_py(), np.int64).view(np.uint64)
                at = np.flatnonzero(np.isin(own[_anchors(own, window - k + 1)], repeated))
                levels = [own, *(grams(words, d) for d in depths[1:]), grams(words, window)]
                for i in range(0, len(at), _EMIT):
                    part = at[i : i + _EMIT]
                    same = pa.array(np.full(len(part), row))
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(same), b.column(1).take(same), pa.array(part),
                         *(pa.array(x[part].view(np.int64)) for x in levels)],
                        ["id", "key", "start", *(f"p{j}" for j in range(len(levels)))],
                    )

    return run


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Walk sorted suffixes (group, salt, leaf, id, key, start): the depth, and for each the smallest id of its node."""
    node, least = None, None
    for b in batches:
        if not len(b):
            continue
        group, salt, leaf, ids = (b.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        new = np.ones(len(b), bool)
        new[1:] = (group[1:] != group[:-1]) | (salt[1:] != salt[:-1]) | (leaf[1:] != leaf[:-1])
        new[0] = node != (group[0], salt[0], leaf[0])
        first = np.where(new, ids, 0)
        if not new[0]:
            first[0] = least
        at = np.maximum.accumulate(np.where(new, np.arange(len(b)), 0))
        smallest = first[at]
        node, least = (group[-1], salt[-1], leaf[-1]), smallest[-1]
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(smallest)], [*b.schema.names, "least"])


def _cut(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, removed, shas, spans = [], [], [], []
            for row in range(len(b)):
                words = [w for block in word_blocks(b.column(2)[row].as_py(), lower=False) for w in block]
                edges = np.zeros(len(words) + 1, np.int64)
                starts = np.unique(np.array(b.column(3)[row].as_py(), np.int64))
                edges[starts] += 1
                np.subtract.at(edges, starts + window, 1)
                gone = np.cumsum(edges[:-1]) > 0
                kept = b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])
                turns = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]))).reshape(-1, 2)
                sizes.append(len(words))
                removed.append(int(gone.sum()))
                shas.append(hashlib.sha256(kept).hexdigest())
                spans.append([{"first": int(x), "stop": int(y)} for x, y in turns])
            kind = pa.list_(pa.struct([("first", pa.int64()), ("stop", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(shas, pa.string()), pa.array(spans, kind)],
                ["id", "n_words", "n_removed", "kept_sha256", "spans"],
            )

    return run


def _partitioned(suffixes: DataFrame, depth: int, most: int) -> DataFrame:
    """Give each suffix its group: the shortest prefix that not more than ``most`` suffixes share."""
    rows = suffixes.withColumn("group", F.col("p0")).withColumn("salt", F.lit(0).cast("long"))
    for level in range(depth):
        large = rows.groupBy("group").agg(F.count("*").alias("n")).where(F.col("n") > most)
        large = settle(large.withColumnRenamed("group", "large"), "repeats-large")
        if large.isEmpty():
            break
        keys = F.broadcast(large) if small_enough(large, 16) else large
        rows = rows.join(keys, F.col("group") == F.col("large"), "left")
        if level + 1 < depth:
            rows = rows.withColumn("group", F.when(F.col("large").isNull(), F.col("group")).otherwise(F.col(f"p{level + 1}")))
        else:  # the window itself: split by document
            salt = F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / most).cast("long"))
            rows = rows.withColumn("salt", F.coalesce(salt, F.lit(0)))
        rows = rows.drop("large", "n")
    return rows


def repeated_windows(suffixes: DataFrame, levels: int, most: int = GROUP) -> DataFrame:
    """``id, key, start`` of the suffixes whose window also starts in a document with a smaller id."""
    leaf = f"p{levels - 1}"
    rows = _partitioned(suffixes, levels, most).select("group", "salt", F.col(leaf).alias("leaf"), "id", "key", "start")
    ordered = rows.repartition("group", "salt").sortWithinPartitions("group", "salt", "leaf", "id")
    schema = ", ".join(f"{n} bigint" for n in (*rows.columns, "least"))
    walked = settle(ordered.mapInArrow(_walk, schema), "repeats-walked")
    # A node that was split by document has several least ids; the smallest of them counts.
    split = walked.where("salt > 0").select("leaf").distinct()
    heads = walked.join(split, "leaf", "left_semi").groupBy("leaf").agg(F.min("least").alias("overall"))
    heads = settle(heads, "repeats-heads")
    marks = walked.where(F.col("id") > F.col("least"))
    if not heads.isEmpty():
        again = walked.where(F.col("id") == F.col("least")).join(heads, "leaf").where(F.col("id") > F.col("overall"))
        marks = marks.unionByName(again.drop("overall"))
    return marks.select("id", "key", "start")


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
    depths: tuple[int, ...] = DEPTHS, group: int = GROUP, broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row per document: ``id_col, n_words, n_removed, kept_sha256, spans`` (removed runs of words).

    A word goes if it is covered by a window whose words also start in a document with a smaller id, judged on the
    input. Null and empty texts and texts shorter than the window lose nothing. A document with a null id is
    compared with none and kept whole; rows with the same id never take words from each other. An empty table gives
    an empty result; further columns are ignored. Ids must be integers.

    Copies of a whole document are settled by its hash: they lose all words, and only the first enters the trees.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = "id bigint, key bigint, n_words bigint, sha string, grams array<bigint>"
    sketch = settle(rows.mapInArrow(_sketch(window, depths[0]), schema), "repeats-sketch")
    known = sketch.where("id IS NOT NULL")
    firsts = known.groupBy("sha").agg(F.min("id").alias("first"))
    known = known.join(firsts, "sha")
    single = known.where("id = first")
    occur = single.select("id", "key", F.explode("grams").alias("gram"))
    shared = occur.groupBy("gram").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a < b").select("gram")
    wanted = occur.join(shared, "gram").groupBy("id", "key").agg(F.collect_list("gram").alias("grams"))
    wanted = settle(wanted, "repeats-wanted")
    levels = len(depths) + 1
    columns = ", ".join(["id bigint", "key bigint", "start bigint", *(f"p{i} bigint" for i in range(levels))])
    candidates = _with_text(rows, wanted, "grams", broadcast_bytes)
    suffixes = settle(candidates.mapInArrow(_suffixes(window, depths), columns), "repeats-suffixes")
    marks = repeated_windows(suffixes, levels, group).groupBy("id", "key").agg(F.collect_list("start").alias("starts"))
    marks = settle(marks, "repeats-marks")
    span = "array<struct<first:bigint,stop:bigint>>"
    cut = _with_text(rows, marks, "starts", broadcast_bytes).mapInArrow(
        _cut(window), f"id bigint, n_words bigint, n_removed bigint, kept_sha256 string, spans {span}"
    )
    nothing, none = F.array().cast(span), F.lit(0).cast("long")
    copy = (F.col("id") > F.col("first")) & (F.col("n_words") >= window)
    everything = F.array(F.struct(none.alias("first"), F.col("n_words").alias("stop")))
    copies = known.where("id > first").select(
        "id", "n_words", F.when(copy, F.col("n_words")).otherwise(none).alias("n_removed"),
        F.when(copy, F.lit(hashlib.sha256().hexdigest())).otherwise(F.col("sha")).alias("kept_sha256"),
        F.when(copy, everything).otherwise(nothing).alias("spans"),
    )
    untouched = single.join(marks, ["id", "key"], "left_anti").drop("first")
    untouched = untouched.unionByName(sketch.where("id IS NULL")).select(
        "id", "n_words", none.alias("n_removed"), F.col("sha").alias("kept_sha256"), nothing.alias("spans")
    )
    return cut.unionByName(copies).unionByName(untouched).withColumnRenamed("id", id_col)


def _with_text(rows: DataFrame, wanted: DataFrame, what: str, limit: int) -> DataFrame:
    """Join per-document lists with the texts: without moving texts if the lists are few, else by a shuffle.

    Several texts may have one id, so the text has to have the hash that the list was made for.
    """
    size = wanted.agg(F.coalesce(F.sum(8 * F.size(what) + 32), F.lit(0))).first()[0]
    joined = rows.join(F.broadcast(wanted) if size <= limit else wanted, "id").select("id", "key", "text", what)
    return joined.mapInArrow(_of_text, f"id bigint, key bigint, text string, {what} array<bigint>")


def _of_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        same = []
        for text, key in zip(b.column(2), b.column(1).to_pylist(), strict=True):
            digest, n = hashlib.sha256(), 0
            for words in word_blocks(text.as_py(), lower=False):
                digest.update((b" " if n else b"") + b" ".join(words) if words else b"")
                n += len(words)
            same.append(int.from_bytes(digest.digest()[:8], "big", signed=True) == key)
        yield b.filter(pa.array(same, pa.bool_()))
