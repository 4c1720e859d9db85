"""Token ids as a wavelet matrix per shard: bit planes with rank directories in one file.

A file holds a header, the ids and lengths of its documents, and one bit plane per bit of the largest token id. Plane
after plane the sequence is stably parted by the bit, zeros first. Rank counts in a plane lead a position to the next
plane, so a token is read, a token's occurrences are counted up to any place and found by number, without decoding.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder
from .memory import give_back
from .text import settle, whole
from .tokens import shared_encoder

END_ID = 2
# Text per shard; a task holds one shard.
SHARD_BYTES = 32 << 20
_MAGIC, _HEAD = b"WVM1", "<4sBQQ"
_BLOCK = 512  # bits per entry of the rank directory
_STRIDE = 1 << 16  # tokens that are moved at once, so that positions stay few


def pack(tokens: np.ndarray, doc_ids: list[int | None], lengths: list[int]) -> bytes:
    """The file of one shard."""
    n, width = len(tokens), max(1, int(tokens.max(initial=0)).bit_length())
    known = np.array([i is not None for i in doc_ids], bool)
    out = [struct.pack(_HEAD, _MAGIC, width, n, len(doc_ids)), np.packbits(known).tobytes(),
           np.array([i or 0 for i in doc_ids], "<i8").tobytes(), np.array(lengths, "<i8").tobytes()]
    for bit in range(width - 1, -1, -1):
        ones = (tokens & tokens.dtype.type(1 << bit)) != 0
        plane = np.packbits(ones)
        padded = np.zeros(-(-max(n, 1) // _BLOCK) * _BLOCK // 8, np.uint8)
        padded[: len(plane)] = plane
        counts = np.bitwise_count(padded).reshape(-1, _BLOCK // 8).sum(axis=1, dtype=np.int64)
        ranks = np.concatenate([[0], np.cumsum(counts)]).astype("<i8")
        out += [ranks.tobytes(), padded.tobytes()]
        if bit:
            tokens = _parted(tokens, ones)
    return b"".join(out)


def _moves(ones: np.ndarray) -> Iterator[tuple[slice, np.ndarray, slice, np.ndarray, slice]]:
    """Stretches of a plane: each with the places of its zeros and ones, and where those lie once the plane is parted."""
    zero, one = 0, len(ones) - int(np.count_nonzero(ones))
    for start in range(0, len(ones), _STRIDE):
        bits = ones[start : start + _STRIDE]
        unset, held = np.flatnonzero(~bits), np.flatnonzero(bits)
        yield slice(start, start + len(bits)), unset, slice(zero, zero + len(unset)), held, slice(one, one + len(held))
        zero, one = zero + len(unset), one + len(held)


def _parted(tokens: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """The tokens stably parted by a bit, zeros first."""
    out = np.empty_like(tokens)
    for at, unset, left, held, right in _moves(ones):
        np.take(tokens[at], unset, out=out[left], mode="clip")
        np.take(tokens[at], held, out=out[right], mode="clip")
    return out


class WaveletShard:
    """Reads the file of a shard: ``access``, ``rank``, ``count``, ``select`` and ``decode``."""

    def __init__(self, data: bytes) -> None:
        magic, self.width, self.size, docs = struct.unpack_from(_HEAD, data)
        if magic != _MAGIC:
            raise ValueError("not a token shard")
        at, marks = struct.calcsize(_HEAD), -(-docs // 8)
        known = np.unpackbits(np.frombuffer(data, np.uint8, marks, at), count=docs).astype(bool)
        ids = np.frombuffer(data, "<i8", docs, at + marks)
        self.doc_ids = pa.array(ids, pa.int64(), mask=~known)
        self.lengths = np.frombuffer(data, "<i8", docs, at + marks + 8 * docs)
        at += marks + 16 * docs
        blocks = -(-max(self.size, 1) // _BLOCK)
        self._planes = []
        for _ in range(self.width):
            ranks = np.frombuffer(data, "<i8", blocks + 1, at)
            plane = np.frombuffer(data, np.uint8, blocks * _BLOCK // 8, at + ranks.nbytes)
            at += ranks.nbytes + plane.nbytes
            self._planes.append((ranks, plane))
        if at != len(data):
            raise ValueError("token shard of the wrong length")

    def _ones(self, level: int, i: int) -> int:
        """Set bits before position i of a plane."""
        ranks, plane = self._planes[level]
        block, rest = divmod(i, _BLOCK)
        if not rest:
            return int(ranks[block])
        part = plane[block * _BLOCK // 8 : block * _BLOCK // 8 + rest // 8 + 1]
        return int(ranks[block]) + int(np.unpackbits(part)[:rest].sum())

    def _zeros(self, level: int) -> int:
        return self.size - int(self._planes[level][0][-1])

    def access(self, i: int) -> int:
        """The token at position i."""
        token = 0
        for level, (_, plane) in enumerate(self._planes):
            bit = int(plane[i >> 3]) >> (7 - (i & 7)) & 1
            ones = self._ones(level, i)
            i = self._zeros(level) + ones if bit else i - ones
            token = token << 1 | bit
        return token

    def _range(self, token: int, stop: int) -> tuple[int, int]:
        start = 0
        for level in range(self.width):
            a, b = self._ones(level, start), self._ones(level, stop)
            if token >> (self.width - 1 - level) & 1:
                start, stop = self._zeros(level) + a, self._zeros(level) + b
            else:
                start, stop = start - a, stop - b
        return start, stop

    def rank(self, token: int, stop: int) -> int:
        """How often the token occurs before position ``stop``."""
        if token >> self.width:
            return 0
        start, stop = self._range(token, stop)
        return stop - start

    def count(self, token: int) -> int:
        return self.rank(token, self.size)

    def select(self, token: int, nth: int) -> int:
        """The position of the nth occurrence, from 0; -1 if there are fewer."""
        if not 0 <= nth < self.count(token):
            return -1
        i = self._range(token, 0)[0] + nth
        for level in range(self.width - 1, -1, -1):
            i = self._find(level, i - self._zeros(level), 1) if i >= self._zeros(level) else self._find(level, i, 0)
        return i

    def _find(self, level: int, nth: int, bit: int) -> int:
        """The position of the nth set or unset bit of a plane."""
        ranks, plane = self._planes[level]
        before = ranks if bit else np.arange(len(ranks)) * _BLOCK - ranks
        block = int(np.searchsorted(before, nth, "right")) - 1
        bits = np.unpackbits(plane[block * _BLOCK // 8 : (block + 1) * _BLOCK // 8])
        return block * _BLOCK + int(np.flatnonzero(bits == bit)[nth - int(before[block])])

    def decode(self) -> np.ndarray:
        """All tokens in order: the planes undone from the last to the first."""
        tokens = np.zeros(self.size, np.uint16 if self.width <= 16 else np.uint32)
        for bit, level in enumerate(range(self.width - 1, -1, -1)):
            tokens[self._zeros(level) :] |= tokens.dtype.type(1 << bit)
            above = np.empty_like(tokens)
            for at, unset, left, held, right in _moves(np.unpackbits(self._planes[level][1], count=self.size).view(bool)):
                above[at][unset] = tokens[left]
                above[at][held] = tokens[right]
            tokens = above
        return tokens


def _file_system(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:/"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its file system, so that executors and driver mean the same place."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()


def write_shards(
    docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Write one file per shard below ``path`` and return its table: ``shard, file, tokens, docs``.

    Documents are in ascending order of id within and across shards (null ids first, ties by text). A task writes
    under a name of its own and renames the file when it is complete, so repeated tasks leave whole files.
    """
    spark = docs.sparkSession
    root = qualified(spark, path)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), whole(text_col).alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text") + 8), F.lit(0))).first()[0]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        encoder, end = shared_encoder(tokenizer, True), np.array([end_id], "<u4")
        parts, ids, lengths = [], [], []
        for b in batches:
            ids += b.column(0).to_pylist()
            for found in encoder.each(text.as_py() for text in b.column(1)):
                own = np.append(np.frombuffer(found, "<u4"), end)
                parts.append(own.astype(np.uint16) if own.max() < 1 << 16 else own)
                lengths.append(len(own))
        if not ids:
            return
        tokens = np.concatenate(parts)
        del b, own
        parts.clear()
        give_back()  # before the planes, which need memory of their own
        task = TaskContext.get()
        name, data = f"shard-{task.partitionId():07d}.wvm", pack(tokens, ids, lengths)
        files, folder = _file_system(root)
        files.create_dir(folder, recursive=True)
        draft = f"{folder}/_{name}.{task.taskAttemptId()}"
        with files.open_output_stream(draft) as f:
            f.write(data)
        files.move(draft, f"{folder}/{name}")
        values = ([task.partitionId()], [f"{root}/{name}"], [sum(lengths)], [len(ids)])
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in values], ["shard", "file", "tokens", "docs"])

    ordered = rows.repartitionByRange(max(1, ceil(total / shard_bytes)), "id").sortWithinPartitions("id", "text")
    return settle(ordered.mapInArrow(write, "shard bigint, file string, tokens bigint, docs bigint"), "token-manifest")


def read_shards(manifest: DataFrame) -> DataFrame:
    """Documents read back from the files: ``doc_id, start, n_tokens, ids_crc32``.

    ``start`` counts the ids of all documents before. Only the manifest, a row per file, is handled by the driver.
    """
    rows, first = [], 0
    for m in manifest.orderBy("shard").collect():
        rows.append((m.file, first))
        first += m.tokens

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                files, name = _file_system(file)
                with files.open_input_stream(name) as f:
                    shard = WaveletShard(f.read())
                tokens, ends = shard.decode(), np.cumsum(shard.lengths)
                crc = [zlib.crc32(tokens[e - n : e].astype("<u4").tobytes()) for e, n in zip(ends, shard.lengths)]
                values = (shard.doc_ids, start + ends - shard.lengths, shard.lengths, crc)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, pa.int64()) for v in values], ["doc_id", "start", "n_tokens", "ids_crc32"]
                )

    files = manifest.sparkSession.createDataFrame(rows, "file string, first bigint").repartition(max(1, len(rows)))
    return files.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_files(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Write all documents as token shards into the shared folder and read them back.

    A null or empty text has the end id alone; repeated rows are repeated documents; a null id stays null and comes
    first; an empty table writes no file and gives an empty result; further columns are ignored.
    """
    path = shared_folder(docs.sparkSession, "tokens")
    return read_shards(write_shards(docs, path, tokenizer, id_col, text_col, **options))
