"""Toxicity by class-conditional Kneser-Ney models of how words are spelt.

Each class has a model of character 6-grams within words. It discounts the class's own counts and gives what is left to
a shared model: interpolated Kneser-Ney over both classes, with continuation counts below the highest order. Expressions too
rare to tell the classes apart so get the same probability in both. A toxic text is taken as ordinary text in
which a small share of the words comes from the toxic model; the log-likelihoods of both readings of a text, per
character, are compared, and a logistic curve turns the difference into a score.

Counts are gathered by Spark from all labelled texts and grow with them, and so do the ratios of the finished model. The
distinct words of all documents are spelt once against all ratios, and documents are read with the values of their words.
Tasks hold the most frequent ratios and values, as many as may be broadcast; all others are joined. Keys and words are told
apart by 64-bit hashes where they are held.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .memory import give_back, returned, small_batches
from .text import BROADCAST_BYTES, row_key, settle, small_enough, without
from .wavelet import _file_system

ORDER, DISCOUNT, STRENGTH, SHARE = 6, 0.75, 50.0, 0.01
# Differences per character far beyond this are compressed before the logistic curve: very short texts reach large ones.
UNIT = 0.001
# At most about this many labelled rows calibrate the score.
CALIBRATION_ROWS = 20_000
THRESHOLD = 0.7
_START, _STOP, _SEED = "\x02", "\x03", 42
_KNOWN, _FLUSH, _TEXTS = 1 << 17, 200_000, 1024
# A hash and a value held by tasks.
_ROW_BYTES = 16


def _grams(word: str) -> list[str]:
    padded = _START * (ORDER - 1) + word + _STOP
    return [padded[i : i + ORDER] for i in range(len(word) + 1)]


@returned
def _count(batches: Iterator[pa.RecordBatch], flush: int = _FLUSH) -> Iterator[pa.RecordBatch]:
    """Grams of (text, class) rows: ``gram, kind, n``; classes of the calibration slice are 2 and 3."""

    def batch() -> pa.RecordBatch:
        rows = [(g, k, n) for k, c in counts.items() for g, n in c.items()]
        gram, kind, n = zip(*rows, strict=True) if rows else ((),) * 3
        return pa.RecordBatch.from_arrays(
            [pa.array(gram, pa.string()), pa.array(kind, pa.int32()), pa.array(n, pa.int64())], ["gram", "kind", "n"]
        )

    give_back()
    counts: dict[int, Counter] = {}
    for b in batches:
        words: dict[int, Counter] = {}
        for text, kind in zip(b.column(0), b.column(1).to_pylist(), strict=True):
            words.setdefault(kind, Counter()).update((text.as_py() or "").lower().split())
        for kind, found in words.items():
            own = counts.setdefault(kind, Counter())
            for word, n in found.items():
                for g in _grams(word):
                    own[g] += n
                if sum(map(len, counts.values())) > flush:
                    yield batch()
                    for sent in counts.values():
                        sent.clear()
    yield batch()


def _shared(grams: DataFrame) -> DataFrame:
    """``gram, shared``: the interpolated probability of a gram's last character after the others, both classes pooled."""
    levels = [grams.select("gram", (F.col("n0") + F.col("n1")).alias("n"))]
    for _ in range(ORDER - 1):
        shorter = levels[-1].groupBy(F.substring("gram", 2, ORDER).alias("gram")).agg(F.count("*").alias("n"))
        levels.append(settle(shorter, "toxicity-level"))
    lower: DataFrame | None = None
    for level in reversed(levels):
        rows = level.select("gram", "n", F.expr("left(gram, length(gram) - 1)").alias("context"))
        around = rows.groupBy("context").agg(F.sum("n").alias("of"), F.count("*").alias("kinds"))
        rows = rows.join(around, "context")
        below: Column = 1.0 / (F.col("kinds") + 1)  # a unigram's context is empty, so kinds is the alphabet
        if lower is not None:
            rows = rows.join(lower, F.substring("gram", 2, ORDER) == F.col("short"))
            below = F.col("p")
        own = F.greatest(F.col("n") - DISCOUNT, F.lit(0.0))
        p = (own + DISCOUNT * F.col("kinds") * below) / F.col("of")
        lower = rows.select(F.col("gram").alias("short"), p.alias("p"))
    return lower.select(F.col("short").alias("gram"), F.col("p").alias("shared"))


def _ratios(grams: DataFrame) -> DataFrame:
    """``key, n, value``: log-likelihood ratios of all seen grams, and by context those of unseen grams after it.

    A gram has ORDER characters and a context one less, so the keys do not mix.
    """
    rows = grams.withColumn("context", F.expr("left(gram, length(gram) - 1)"))
    around = rows.groupBy("context").agg(*[
        x for i in (0, 1) for x in (
            F.sum(f"n{i}").alias(f"of{i}"), F.sum((F.col(f"n{i}") > 0).cast("long")).alias(f"kinds{i}"))
    ])
    around = settle(around, "toxicity-contexts")

    def free(i: int) -> Column:
        return STRENGTH + DISCOUNT * F.col(f"kinds{i}")

    def probability(i: int) -> Column:
        own = F.greatest(F.col(f"n{i}") - DISCOUNT, F.lit(0.0))
        return (own + free(i) * F.col("shared")) / (STRENGTH + F.col(f"of{i}"))

    seen = rows.join(_shared(grams), "gram").join(around, "context").select(
        F.col("gram").alias("key"), (F.col("n0") + F.col("n1")).alias("n"),
        (F.log(probability(1)) - F.log(probability(0))).alias("value"),
    )
    unseen = around.select(
        F.col("context").alias("key"), (F.col("of0") + F.col("of1")).alias("n"),
        (F.log(free(1) / (STRENGTH + F.col("of1"))) - F.log(free(0) / (STRENGTH + F.col("of0")))).alias("value"),
    )
    return settle(seen.unionByName(unseen), "toxicity-ratios")


class _Table:
    """Hashes and values that tasks hold, read by each of them from a written table in order of hash."""

    def __init__(self, files: list[str]) -> None:
        self._files = files

    def load(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted by hash. A piece of a file at a time is read into arrays of the final size."""
        opened = []
        for file in self._files:
            system, name = _file_system(file)
            opened.append(pq.ParquetFile(system.open_input_file(name)))
        size = sum(f.metadata.num_rows for f in opened)
        hashes, values, at = np.empty(size, np.int64), np.empty(size), 0
        for f in opened:
            for part in f.iter_batches(1 << 16, columns=["hash", "value"]):
                hashes[at : at + part.num_rows] = part.column(0).to_numpy()
                values[at : at + part.num_rows] = part.column(1).to_numpy()
                at += part.num_rows
            f.close(force=True)
        return hashes, values


def _held(rows: DataFrame, limit: int) -> tuple[_Table, bool]:
    """The most frequent of ``hash, n, value`` that fit ``limit`` bytes; whether these are all."""
    level = F.length(F.bin("n"))
    sizes = dict(tuple(r) for r in rows.groupBy(level).count().collect())
    least, total = 65, 0
    for at in sorted(sizes, reverse=True):
        total += _ROW_BYTES * sizes[at]
        if total > limit:
            break
        least = at
    # One file: the rows were counted to fit the limit for what tasks hold.
    kept = rows.where(level >= least).select("hash", "value").repartition(1).sortWithinPartitions("hash")
    return _Table(settle(kept, "toxicity-held").inputFiles()), least <= min(sizes, default=0) or not sizes


def _hashes(keys: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(k, _SEED) for k in keys], np.uint64).view(np.int64)


def _look_up(table: tuple[np.ndarray, np.ndarray], keys: list[str]) -> np.ndarray:
    """Values, NaN where the table has no such key."""
    held, values = table
    if not len(held) or not keys:
        return np.full(len(keys), np.nan)
    hashes = _hashes(keys)
    at = np.minimum(np.searchsorted(held, hashes), len(held) - 1)
    return np.where(held[at] == hashes, values[at], np.nan)


def _words(docs: DataFrame) -> DataFrame:
    """``hash, n, word`` of every distinct word of all texts."""

    @returned
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        counts: Counter = Counter()

        def batch() -> pa.RecordBatch:
            columns = [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["word", "n"])

        for b in batches:
            for text in b.column(0):
                counts.update((text.as_py() or "").lower().split())
                if len(counts) > _FLUSH:
                    yield batch()
                    counts.clear()
        yield batch()

    found = docs.select("text").mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return found.select(F.xxhash64("word").alias("hash"), "n", "word")


def _values(words: DataFrame, ratios: DataFrame, share: float, limit: int) -> DataFrame:
    """``hash, n, value`` per word: the log-likelihood ratio of a text with toxic words to one without, at this word.

    Grams that tasks do not hold are joined with the ratios, by the gram or else by its context.
    """
    held, whole = _held(ratios.select(F.xxhash64("key").alias("hash"), "n", "value"), limit)

    @returned
    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        table = held.load()
        for b in batches:
            for part in (b.slice(i, 4096) for i in range(0, b.num_rows, 4096)):
                spelt = [_grams(w) for w in part.column(2).to_pylist()]
                flat, starts = [g for s in spelt for g in s], np.cumsum([0, *map(len, spelt)])
                ratio = _look_up(table, flat)
                open_ = np.flatnonzero(np.isnan(ratio))
                ratio[open_] = np.nan_to_num(_look_up(table, [flat[i][:-1] for i in open_])) if whole else 0.0
                left = [] if whole else [flat[i] for i in open_]
                ends = np.searchsorted(open_, starts) if left else np.zeros(len(starts), int)
                rest = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(left, pa.string()))
                total = pa.array(np.add.reduceat(ratio, starts[:-1]))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), total, rest], ["hash", "n", "total", "rest"])

    found = words.mapInArrow(spell, "hash bigint, n bigint, total double, rest array<string>")
    if not whole:
        found = settle(found, "toxicity-spelt")
        by_gram, by_context = (ratios.select(F.col("key").alias(k), F.col("value").alias(v)) for k, v in (("gram", "own"), ("after", "open")))
        need = found.select("hash", F.explode("rest").alias("gram")).join(by_gram, "gram", "left")
        # A gram that is found equals no context and stays spread.
        after = F.when(F.col("own").isNull(), F.expr("left(gram, length(gram) - 1)")).otherwise(F.col("gram"))
        need = need.withColumn("after", after).join(by_context.where(F.length("after") < ORDER), "after", "left")
        more = need.groupBy("hash").agg(F.sum(F.coalesce("own", "open", F.lit(0.0))).alias("more"))
        found = found.join(more, "hash", "left").withColumn("total", F.col("total") + F.coalesce("more", F.lit(0.0)))
    value = F.log1p(share * F.expm1(F.least("total", F.lit(60.0))))
    return settle(found.select("hash", "n", value.alias("value")), "toxicity-words")


class _Reader:
    """Gains of texts by the values of their words; remembers words up to a fixed number."""

    def __init__(self, table: tuple[np.ndarray, np.ndarray]) -> None:
        self._table, self._known = table, {}

    def of(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[list[tuple[str, int]]]]:
        """Per text the gain by known words, its characters and its other words with their numbers."""
        gains, sizes, rest = np.zeros(len(texts)), np.zeros(len(texts), np.int64), []
        for i, text in enumerate(texts):
            words = Counter((text or "").lower().split())
            if len(self._known) > _KNOWN:
                self._known.clear()
            known = self._known
            if new := [w for w in words if w not in known]:
                known.update(zip(new, _look_up(self._table, new).tolist(), strict=True))
            gain = sum([known[w] * n for w, n in words.items()])
            others = []
            if gain != gain:
                others = [(w, n) for w, n in words.items() if known[w] != known[w]]
                gain = sum([known[w] * n for w, n in words.items() if known[w] == known[w]])
            gains[i], sizes[i] = gain, sum([(len(w) + 1) * n for w, n in words.items()])
            rest.append(others)
        return gains, sizes, rest


def _read(docs: DataFrame, values: DataFrame, limit: int) -> DataFrame:
    """Replace ``text`` by ``x``, the difference of log-likelihoods per character; ``values`` has all words of the texts.

    Words that tasks do not hold are joined. A document is then known by its id and the hash of its text.
    """
    held, whole = _held(values, limit)
    rows = docs if whole else docs.select("id", "text", F.xxhash64("text").alias("of"))
    kept = StructType([f for f in rows.schema.fields if f.name != "text"])
    out = "gain double, size bigint, others bigint, rest array<struct<hash: bigint, n: bigint>>"

    @returned
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        reader = _Reader(held.load())
        for b in (b.slice(i, _TEXTS) for b in batches for i in range(0, b.num_rows, _TEXTS)):
            gains, sizes, rest = reader.of(b.column(b.schema.names.index("text")).to_pylist())
            flat = [p for r in rest for p in r]
            pairs = pa.StructArray.from_arrays(
                [pa.array(_hashes([w for w, _ in flat])), pa.array([n for _, n in flat], pa.int64())], ["hash", "n"]
            )
            others = pa.array([sum([n for _, n in r]) for r in rest], pa.int64())
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, rest)]), pa.int32()), pairs)
            columns = [b.column(b.schema.names.index(n)) for n in kept.names]
            columns += [pa.array(gains), pa.array(sizes), others, lists]
            yield pa.RecordBatch.from_arrays(columns, [*kept.names, "gain", "size", "others", "rest"])

    read = rows.mapInArrow(run, StructType([*kept.fields, *StructType.fromDDL(out).fields]))
    x = F.when(F.col("size") > 0, F.col("gain") / F.col("size")).otherwise(0.0)
    if whole:
        return read.select(*kept.names, x.alias("x"))
    read = settle(read, "toxicity-read")
    few = read.select("id", "of", F.inline("rest")).join(values.select("hash", "value"), "hash")
    # Repeated rows have the same words, so the mean over all of them is the mean of each.
    mean = F.sum(F.col("n") * F.col("value")) / F.sum("n")
    more = few.groupBy("id", "of").agg(mean.alias("mean")).toDF("_id", "_of", "mean")
    read = read.drop("rest").join(more, F.col("id").eqNullSafe(F.col("_id")) & (F.col("of") == F.col("_of")), "left")
    read = read.withColumn("gain", F.col("gain") + F.col("others") * F.coalesce("mean", F.lit(0.0)))
    found = read.select("id", "of", x.alias("x"))
    names = [n for n in docs.columns if n != "text"]
    if names == ["id"]:
        return found.select("id", "x")
    found = settle(found.groupBy("id", "of").agg(F.max("x").alias("x")).toDF("_id", "_of", "x"), "toxicity-differences")
    found = F.broadcast(found) if small_enough(found, 48, limit) else found
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_of"))
    return docs.join(found, same).select(*names, "x")


def _differences(docs: DataFrame, grams: DataFrame, share: float, limit: int) -> DataFrame:
    """Replace ``text`` of documents with an ``id`` by ``x``, under the model of the counts ``gram, n0, n1``."""
    return _read(docs, _values(_words(docs), _ratios(grams), share, limit), limit)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton's method with a small ridge; without both classes, a constant."""
    if not len(y) or y.min() == y.max():
        return 0.0, (-20.0 if not len(y) or not y.max() else 20.0)
    a = np.stack([x, np.ones(len(x))], axis=1)
    w, ridge = np.zeros(2), np.array([1e-3, 1e-4])

    def loss(w: np.ndarray) -> float:
        z = a @ w
        return float(np.sum(np.logaddexp(0, z) - y * z) + ridge @ w**2 / 2)

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -500, 500)))
        slope = a.T @ (p - y) + ridge * w
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag(ridge), slope)
        while loss(w - step) > loss(w) and np.abs(step).max() > 1e-12:
            step /= 2
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def score_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    threshold: float = THRESHOLD, calibration_rows: int = CALIBRATION_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES, carry: bool = False,
) -> DataFrame:
    """One row per document: ``id_col, held_out, score, predicted``; with ``carry`` also ``key``, its ``row_key``.

    Learns from labelled documents that are not held out (crc32 of the id modulo 3 is 1). A tenth of them, at most about
    ``calibration_rows``, is scored by a model of the others to fit the logistic curve; the final model counts all. If an id
    has several labels the largest counts; null labels are left out. Without labels of both classes the score is
    constant. A null or empty text differs by 0. A null id is not held out and not learned from. Repeated rows
    give repeated results; an empty table gives an empty result; further columns are ignored.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
        *([row_key(id_col, text_col).alias("key")] if carry else []),
    )
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).dropna()
    known = settle(known.where(~held_out(F.col("id"))).groupBy("id").agg(F.max("y").alias("y")), "toxicity-labels")
    slice_ = F.pmod(F.xxhash64("id"), F.lit(10)) == 0
    train = rows.join(F.broadcast(known) if small_enough(known, 16, broadcast_bytes) else known, "id")
    marked = train.select("text", (F.col("y") + F.when(slice_, 2).otherwise(0)).alias("kind"))
    counted = marked.mapInArrow(_count, "gram string, kind int, n bigint").groupBy("gram").agg(
        *[F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("n"))), F.lit(0)).alias(f"k{k}") for k in range(4)]
    )
    counted = settle(counted, "toxicity-grams")
    part = counted.select("gram", F.col("k0").alias("n0"), F.col("k1").alias("n1")).where("n0 + n1 > 0")
    full = counted.select("gram", (F.col("k0") + F.col("k2")).alias("n0"), (F.col("k1") + F.col("k3")).alias("n1"))
    aside = known.where(slice_).count()
    share = F.pmod(F.xxhash64(F.lit("calibration"), F.col("id")), F.lit(1 << 20)) < int(min(1.0, calibration_rows / max(1, aside)) * (1 << 20))
    sample = settle(train.where(slice_ & share).select("id", "text", "y"), "toxicity-sample")
    sample = _differences(sample, part, SHARE, broadcast_bytes).select("y", "x")
    pairs = np.array([tuple(r) for r in sample.collect()], float).reshape(-1, 2)
    slope, offset = _logistic(np.arcsinh(pairs[:, 1] / UNIT), pairs[:, 0])
    read = _differences(rows, full, SHARE, broadcast_bytes)
    score = 1.0 / (1.0 + F.exp(-(slope * F.asinh(F.col("x") / UNIT) + offset)))
    return read.select(
        F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), score.alias("score"),
        (score >= threshold).cast("int").alias("predicted"), *(["key"] if carry else []),
    )


def drop_toxic(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """The documents that are not predicted to be toxic, with all their columns; each row is judged by its own text.

    Null and empty texts are judged like any other; repeated rows stay or go together; without labels of both classes
    one constant score decides for all; an empty table stays empty. Only the keys of dropped rows are joined.
    """
    found = score_toxicity(docs, labels, id_col, text_col, carry=True, **options)
    return without(docs, id_col, text_col, found.where("predicted = 1").select("key"))
