"""Spelling variants: words one edit apart, found by dynamic programming over sorted word lists.

Two words one edit apart agree before and behind the edit. Whatever half of the shorter word the edit lies in, the
other half stands unchanged in both, so words meet in groups of one unchanged part, and groups that are still crowded
are parted again by the halves of what is left, down to a single open place. In a group the open parts form a sorted
list. It is scanned once for all words of the group: the edit matrix keeps the three cells around its diagonal, one row
per character of the list; a list entry reuses the rows of what it has in common with the entry before, words whose
row exceeds one edit leave the rows below it, and where none is left, all entries with that beginning are skipped.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import settle, small_enough

LEAST_LENGTH, LEAST_COUNT, RATIO, TYPO_OF = 7, 2, 10, 31
# Words of a group beyond which it is parted further.
CROWDED = 2048
# Few words or candidates are compared row by row without arrays.
_FEW = 6
_FLUSH, _BLOCK = 200_000, 1 << 20
_GAP = re.compile("[^a-zÀ-ÿ]")


def _blocks(text: str) -> Iterator[str]:
    start = 0
    while start < len(text):
        gap = _GAP.search(text, start + _BLOCK) if start + _BLOCK < len(text) else None
        stop = gap.end() if gap else len(text)
        yield text[start:stop]
        start = stop


def vocabulary(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LEAST_LENGTH,
    count: int = LEAST_COUNT, typo_of: int = TYPO_OF,
) -> DataFrame:
    """``word, n``: runs of letters of all whole texts, A-Z in lower case, with their numbers of occurrences.

    Where ``typo_of`` divides the checksum of ``<id>:<run>``, the run loses the code point that the checksum points at.
    Kept are words of at least ``length`` code points and ``count`` occurrences. Tasks send counts, never texts.
    """
    find = re.compile(f"[a-zÀ-ÿ]{{{length},}}").findall

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def batch() -> pa.RecordBatch:
            columns = [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["word", "n"])

        for b in batches:
            for id_, text in zip(b.column(0), b.column(1), strict=True):
                start = zlib.crc32(f"{id_.as_py() or ''}:".encode())
                for block in _blocks((text.as_py() or "").encode().lower().decode()):
                    for word, n in Counter(find(block)).items():
                        h = zlib.crc32(word.encode(), start)
                        if h % typo_of == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < length:
                                continue
                        counts[word] += n
                if len(counts) > _FLUSH:
                    yield batch()
                    counts.clear()
        yield batch()

    rows = docs.select(F.col(id_col).cast("string"), F.col(text_col).cast("string"))
    found = rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return found.where(F.col("n") >= count)


def _parted(rows: DataFrame) -> DataFrame:
    """Rows ``m, lo, hi, word, n`` with the open part ``[lo, hi)`` of the shorter word halved."""
    mid = F.expr("cast(lo + (hi - lo) div 2 as int)")
    halves = F.array(F.struct(F.col("lo").alias("lo"), mid.alias("hi")), F.struct(mid.alias("lo"), F.col("hi").alias("hi")))
    return rows.select("m", "word", "n", F.inline(F.filter(halves, lambda h: h["lo"] < h["hi"])))


def _key() -> Column:
    """What words of a group share: the length of the shorter word, the open part and what stands around it."""
    before = F.expr("left(word, lo)")
    behind = F.expr("right(word, m - hi)")
    return F.concat_ws("|", "m", "lo", "hi", before, behind)


def _groups(words: DataFrame, least: int, most: int) -> DataFrame:
    """``key, open, n``: every word in all groups in which it can meet a word one edit away."""
    size = F.char_length("word")
    shorter = F.explode(F.filter(F.array(size, size - 1), lambda m: m >= least))
    rows = words.select("word", "n", shorter.alias("m"))
    rows = _parted(rows.select("m", F.lit(0).alias("lo"), F.col("m").alias("hi"), "word", "n"))
    open_ = F.substring("word", F.col("lo") + 1, F.char_length("word") - F.col("m") + F.col("hi") - F.col("lo"))
    done = None
    while True:
        rows = rows.withColumn("key", _key())
        # One open place needs no parting: the words of such a group differ in one letter of the alphabet.
        crowded = rows.where("hi - lo > 1").groupBy("key").agg(F.count("*").alias("of")).where(F.col("of") > most)
        crowded = settle(crowded.select("key"), "variants-crowded")
        last = crowded.isEmpty()
        hint = F.broadcast(crowded) if small_enough(crowded, 256) else crowded
        part = (rows if last else rows.join(hint, "key", "left_anti")).select("key", open_.alias("open"), "n")
        done = part if done is None else done.unionByName(part)
        if last:
            return done
        rows = settle(_parted(rows.join(hint, "key", "left_semi")), "variants-parted")


def _rows_after(row: tuple[int, int, int], word: str, entry: str, depth: int) -> int:
    """Edits between a word and a list entry, 2 for more than one, from the banded row at a depth on."""
    r0, r1, r2 = row
    size = len(word)
    for d in range(depth, len(entry)):
        c = entry[d]
        n0 = min(r1 + 1, r0 + (not 0 < d <= size or word[d - 1] != c))
        n1 = min(r1 + (d >= size or word[d] != c), r2 + 1, n0 + 1)
        r2 = min(r2 + (d + 1 >= size or word[d + 1] != c), n1 + 1)
        r0, r1 = n0, n1
        if r0 > 1 and r1 > 1 and r2 > 1:
            return 2
    at = size - len(entry)
    return (r0, r1, r2)[at + 1] if -1 <= at <= 1 else 2


def near_in_list(entries: list[str]) -> Iterator[tuple[int, int]]:
    """Ordered pairs (word, entry) of positions in a sorted list of different words that are one edit apart."""
    total, first = len(entries), (2, 0, 1)
    if total <= _FEW:
        for i in range(total):
            for j in range(i):
                if _rows_after(first, entries[i], entries[j], 0) == 1:
                    yield i, j
                    yield j, i
        return
    sizes = np.array([len(e) for e in entries])
    width = int(sizes.max()) + 2
    padded = "".join([e.ljust(width, "\0") for e in entries])
    codes = np.frombuffer(padded.encode("utf-32-le", "surrogatepass"), "<u4").reshape(total, width)
    shifted = np.concatenate([np.zeros((total, 1), "<u4"), codes], axis=1)
    same = np.logical_and.accumulate(codes[1:] == codes[:-1], axis=1).sum(axis=1)
    common = [0, *np.minimum(same, np.minimum(sizes[1:], sizes[:-1])).tolist(), 0]
    whole = np.arange(total)
    rows = [(whole, np.full(total, 2, np.int8), np.zeros(total, np.int8), np.ones(total, np.int8))]
    at = 0
    while at < total:
        depth, entry = common[at], entries[at]
        del rows[depth + 1 :]
        skip = 0
        while depth < len(entry):
            words, r0, r1, r2 = rows[-1]
            alone = common[at + 1] <= depth  # no other entry goes through the next row
            if alone and len(words) <= _FEW:
                break
            c = codes[at, depth]
            around = shifted[words, depth : depth + 3] != c
            n0 = np.minimum(r1 + 1, r0 + around[:, 0])
            n1 = np.minimum(np.minimum(r1 + around[:, 1], r2 + 1), n0 + 1)
            n2 = np.minimum(r2 + around[:, 2], n1 + 1)
            kept = np.flatnonzero(np.minimum(np.minimum(n0, n1), n2) <= 1)
            depth += 1
            if not len(kept):
                skip = depth
                break
            rows.append((words[kept], n0[kept], n1[kept], n2[kept]))
        if not skip:
            words, r0, r1, r2 = rows[-1]
            if depth < len(entry):
                for i, *row in zip(words.tolist(), r0.tolist(), r1.tolist(), r2.tolist(), strict=True):
                    if i != at and _rows_after(row, entries[i], entry, depth) == 1:
                        yield i, at
            else:
                last = sizes[words] - len(entry)
                cell = np.where(last == -1, r0, np.where(last == 0, r1, np.where(last == 1, r2, 2)))
                for i in words[cell == 1].tolist():
                    yield i, at
            at += 1
        else:
            at += 1
            while at < total and common[at] >= skip:
                at += 1


def _first_difference(a: str, b: str) -> int:
    return next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


def _near_words(key: str, entries: list[str], counts: list[int]) -> list[tuple[str, int, int, str]]:
    """Of a group: words, how many words are near in it, and the largest of those (ties: the smallest word)."""
    m, lo, hi, before, behind = key.split("|")
    m, lo, hi = int(m), int(lo), int(hi)
    near: dict[int, list] = {}
    for i, j in near_in_list(entries):
        a, b = entries[i], entries[j]
        if len(a) == len(b):
            if len(a) > hi - lo:
                continue  # both are longer; they meet where the shorter length is theirs
        elif hi < m and lo + _first_difference(a, b) >= hi:
            continue  # an inserted letter may be any of a run of equal ones; the first place counts
        found = near.setdefault(i, [0, -1, ""])
        found[0] += 1
        if counts[j] > found[1] or (counts[j] == found[1] and b < found[2]):
            found[1:] = counts[j], b
    return [(f"{before}{entries[i]}{behind}", n, most, f"{before}{best}{behind}") for i, (n, most, best) in near.items()]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, entries, counts, out = None, [], [], []

    def batch() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [()] * 4
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
        out.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["word", "n_near", "form_n", "form"]
        )

    for b in batches:
        for k, open_, n in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
            if k != key:
                if len(entries) > 1:
                    out += _near_words(key, entries, counts)
                key, entries, counts = k, [], []
            entries.append(open_)
            counts.append(n)
        yield batch()
    if len(entries) > 1:
        out += _near_words(key, entries, counts)
    yield batch()


def near_words(words: DataFrame, least: int = LEAST_LENGTH, most: int = CROWDED) -> DataFrame:
    """``word, n_near, form_n, form`` for words with near words: how many, and the most frequent of them.

    ``words`` has distinct words of letters in ``word`` and their numbers in ``n``, none shorter than ``least``. A group
    sends one row per word, so a crowded one makes no more rows than it has words.
    """
    grouped = _groups(words, least, most).repartition("key").sortWithinPartitions("key", "open")
    found = grouped.mapInArrow(_scan, "word string, n_near bigint, form_n bigint, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("n"), "form"))
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return found.select("word", "n_near", (-F.col("best.n")).alias("form_n"), "best.form")


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root``: forms followed to the last, twice as far in every round."""
    roots = settle(forms.select("word", F.col("form").alias("root")), "variants-roots")
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ahead = F.broadcast(ahead) if small_enough(roots, 128) else ahead
        far = settle(roots.join(ahead, "root", "left"), "variants-roots")
        if far.where("next IS NOT NULL").isEmpty():
            return roots
        roots = far.select("word", F.coalesce("next", "root").alias("root"))


def spelling_variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ratio: int = RATIO, length: int = LEAST_LENGTH,
    count: int = LEAST_COUNT, typo_of: int = TYPO_OF, most: int = CROWDED,
) -> DataFrame:
    """One row per word: ``word, form, root, n, n_near, form_n``.

    A word's form is the most frequent word one edit away (ties: the smallest in code-point order) if it is at least ``ratio``
    times as frequent, else null, as is ``form_n``; the root is where forms lead in the end. Null and empty texts have no words; a null id
    counts as an empty one in checksums; repeated rows count again; an empty table gives an empty result; further columns are
    ignored. Words of any length are handled; ties are broken as stated.
    """
    if ratio < 2:
        raise ValueError("a form must be more frequent than its word")
    words = settle(vocabulary(docs, id_col, text_col, length, count, typo_of), "variants-words")
    near = words.join(near_words(words, length, most), "word", "left")
    has_form = F.col("form_n") >= ratio * F.col("n")
    near = settle(near.select(
        "word", F.when(has_form, F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(has_form, F.col("form_n")).alias("form_n"),
    ), "variants-near")
    roots = _roots(near.where("form IS NOT NULL"))
    out = near.join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
