"""WARC archives through a table of chunks: no payload is ever held whole by the code that writes or reads it.

A payload becomes rows of a record number and a chunk number. Digests are carried from chunk to chunk, so a record's
length and digest stand in the row of its last chunk. From those rows alone it is decided which records repeat an earlier
payload. Archives are written chunk by chunk, every record a gzip member of its own, and read back the same way:
a record is announced, streamed through a buffer of fixed size, and closed with the digest of what went through.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shared_folder
from .text import settle, small_enough
from .wavelet import _file_system, qualified

CHUNK_BYTES = 256 << 10
# A file is closed after the record that reaches this many bytes.
FILE_BYTES = 64 << 20
# Payloads of fewer bytes are always stored.
LEAST_REVISIT = 100
_READ, _LEVEL = 256 << 10, 3
# Lines of the format.
_VERSION, _END = b"WARC/1.1\r\n", b"\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_DATE = "1970-01-01T00:00:00Z"


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compress chunks, which come in order, and add the bytes so far and, to a record's last one, the record's digest."""
    digest, size = hashlib.sha256(), 0
    for b in batches:
        sizes, digests, packed = [], [], []
        at = b.schema.names.index("data")
        for chunk, last, data in zip(b.column("chunk").to_pylist(), b.column("last").to_pylist(), b.column(at), strict=True):
            if chunk == 0:
                digest, size = hashlib.sha256(), 0
            data = memoryview(data.as_buffer()) if data.is_valid else b""
            digest.update(data)
            size += len(data)
            sizes.append(size)
            digests.append(digest.hexdigest() if last else None)
            packed.append(zlib.compress(data, _LEVEL))
        columns = [c for n, c in zip(b.schema.names, b.columns, strict=True) if n != "data"]
        columns += [pa.array(packed, pa.binary()), pa.array(sizes, pa.int64()), pa.array(digests, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, [*[n for n in b.schema.names if n != "data"], "packed", "bytes", "sha256"])


def chunk_table(
    pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", uri_col: str | None = "url",
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """Payloads as written rows ``record, page, uri, chunk, last, packed, bytes, sha256``.

    ``record`` numbers the rows of the input, repeated ones too. A text is its UTF-8 bytes; null is an empty payload of one
    empty chunk. ``packed`` is a chunk in zlib form, which is how it is stored and shuffled; ``bytes`` is the length up to a
    chunk, ``sha256`` stands in the last one.
    """
    payload = F.col(payload_col)
    if pages.schema[payload_col].dataType.simpleString() != "binary":
        payload = F.encode(payload.cast("string"), "UTF-8")
    uri = F.col(uri_col).cast("string") if uri_col else F.lit(None).cast("string")
    rows = pages.select(
        F.monotonically_increasing_id().alias("record"), F.col(id_col).alias("page"), uri.alias("uri"),
        F.coalesce(payload, F.lit(b"")).alias("payload"),
    )
    last = F.greatest(F.ceil(F.octet_length("payload") / chunk_bytes) - 1, F.lit(0)).cast("int")
    chunks = rows.select("*", last.alias("of"), F.explode(F.sequence(F.lit(0), last)).alias("chunk"))
    chunks = chunks.select(
        "record", "page", "uri", "chunk", (F.col("chunk") == F.col("of")).alias("last"),
        F.substring("payload", F.col("chunk") * chunk_bytes + 1, F.lit(chunk_bytes)).alias("data"),
    )
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in chunks.schema.fields if f.name != "data")
    return settle(chunks.mapInArrow(_digested, f"{kinds}, packed binary, bytes bigint, sha256 string"), "warc-chunks")


def revisits(chunks: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """``record, refers_page, refers_record`` for the records whose payload another record stores.

    Of equal payloads of at least ``least`` bytes the smallest page is stored (null pages last, repeated rows by their
    number). Counts are merged before they are shuffled; only digests of repeated payloads are joined.
    """
    whole = chunks.where("last").select("record", "page", "bytes", "sha256").where(F.col("bytes") >= least)
    order = F.struct(F.col("page").isNull().alias("unknown"), "page", "record")
    groups = whole.groupBy("sha256").agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1")
    groups = settle(groups.select("sha256", "first.page", "first.record").toDF("sha256", "refers_page", "refers_record"), "warc-repeated")
    hint = F.broadcast(groups) if small_enough(groups, 128) else groups
    return settle(
        whole.join(hint, "sha256").where("record <> refers_record").select("record", "refers_page", "refers_record"),
        "warc-revisits",
    )


def _urn(record: Column) -> Column:
    """The name of a record: a UUID made of its number; null for none."""
    digits = F.lower(F.lpad(F.hex(record), 32, "0"))
    cuts = [F.substring(digits, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.when(record.isNotNull(), F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">")))


def _header(kind: str, row: dict, size: int) -> bytes:
    fields = [
        ("WARC-Type", kind), ("WARC-Record-ID", row["urn"]), ("WARC-Date", _DATE),
        ("WARC-Target-URI", quote(row["uri"], safe=":/?#[]@!$&'()*+,;=%-._~") if row["uri"] is not None else None),
        ("WARC-Payload-Digest", f"sha256:{row['sha256']}"),
        ("WARC-Profile", _PROFILE if kind == "revisit" else None), ("WARC-Refers-To", row["refers"]),
        ("X-Page", quote(row["page"]) if row["page"] is not None else None),
        ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(size)),
    ]
    return _VERSION + "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None).encode() + b"\r\n"


class _Archive:
    """Archive files of one task, opened as they are needed and renamed when they are whole."""

    def __init__(self, root: str, file_bytes: int) -> None:
        task = TaskContext.get()
        self._root, self._file_bytes = root, file_bytes
        self._name, self._attempt, self._count = f"{task.partitionId():07d}", task.taskAttemptId(), 0
        self._files, self._folder = _file_system(root)
        self._files.create_dir(self._folder, recursive=True)
        self._out = None
        self.done: list[tuple[str, int]] = []

    def start(self) -> None:
        """Begin a record."""
        if self._out is None:
            self._own = f"part-{self._name}-{self._count:05d}.warc.gz"
            self._draft = f"{self._folder}/_{self._own}.{self._attempt}"
            self._out, self._records, self._count = self._files.open_output_stream(self._draft, compression=None), 0, self._count + 1
        self._gzip = zlib.compressobj(_LEVEL, zlib.DEFLATED, 31)

    def put(self, data: bytes) -> None:
        if packed := self._gzip.compress(data):
            self._out.write(packed)

    def end(self) -> None:
        """Close a record."""
        self._out.write(self._gzip.flush())
        self._records += 1
        if self._out.tell() >= self._file_bytes:
            self.close()

    def close(self) -> None:
        if self._out is not None:
            self._out.close()
            self._files.move(self._draft, f"{self._folder}/{self._own}")
            self.done.append((f"{self._root}/{self._own}", self._records))
            self._out = None


def write_archives(chunks: DataFrame, repeats: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a table of chunks as archives below ``path`` and return the table of files: ``file, records``.

    Records listed in ``repeats`` become revisits without a payload, all others responses. Chunks of a record
    come one after another, so a task holds one chunk. A task writes under names of its own and renames whole files.
    """
    root = qualified(chunks.sparkSession, path)
    whole = chunks.where("last").select("record", F.col("bytes").alias("total"), F.col("sha256").alias("digest"))
    facts = whole.join(repeats.select("record", "refers_record"), "record", "left")
    # Chunks and facts of a record meet in one task; of a revisit the first chunk will do, without its data.
    first = chunks.where("chunk = 0").select("record", "page", "uri")
    heads = first.join(facts, "record").select(
        "record", F.lit(-1).alias("chunk"), F.col("page").cast("string").alias("page"), "uri", "total", F.col("digest").alias("sha256"),
        _urn(F.col("record")).alias("urn"), _urn(F.col("refers_record")).alias("refers"), F.lit(None).cast("binary").alias("packed"),
    )
    gone = repeats.select("record")
    stored = chunks.join(F.broadcast(gone) if small_enough(gone, 16) else gone, "record", "left_anti")
    bodies = stored.select(
        "record", "chunk", *[F.lit(None).cast("string").alias(n) for n in ("page", "uri")], F.lit(None).cast("bigint").alias("total"),
        *[F.lit(None).cast("string").alias(n) for n in ("sha256", "urn", "refers")], "packed",
    )
    parts = heads.unionByName(bodies).repartition("record").sortWithinPartitions("record", "chunk")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, opened = None, False
        for b in batches:
            heads_ = b.select(["page", "uri", "total", "sha256", "urn", "refers"])
            data_at = b.schema.names.index("packed")
            for i, chunk in enumerate(b.column(b.schema.names.index("chunk")).to_pylist()):
                archive = archive or _Archive(root, file_bytes)
                if chunk >= 0:
                    archive.put(zlib.decompress(b.column(data_at)[i].as_buffer()))
                    continue
                if opened:
                    archive.put(_END)
                    archive.end()
                row = heads_.slice(i, 1).to_pylist()[0]
                http, kind = _HTTP % row["total"], "revisit" if row["refers"] else "response"
                archive.start()
                archive.put(_header(kind, row, len(http) + (row["total"] if kind == "response" else 0)) + http)
                opened = True
        if archive:
            if opened:
                archive.put(_END)
                archive.end()
            archive.close()
            files, records = zip(*archive.done, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(files), pa.array(records, pa.int64())], ["file", "records"])

    return settle(parts.mapInArrow(write, "file string, records bigint"), "warc-files")


class _Stream:
    """What gzip members of a file hold, a bounded piece at a time."""

    def __init__(self, file) -> None:
        self._file, self._held, self._gzip, self._packed = file, b"", zlib.decompressobj(31), b""
        self._begun = False  # whether the member at hand has bytes

    def _more(self) -> bool:
        while True:
            if self._gzip.eof:
                self._packed = self._gzip.unused_data or self._packed
                self._gzip, self._begun = zlib.decompressobj(31), False
            packed = self._packed or self._file.read(_READ)
            self._begun = self._begun or bool(packed)
            self._packed = b""
            found = self._gzip.decompress(packed, _READ)
            self._packed = self._gzip.unconsumed_tail
            if found:
                self._held += found
                return True
            if not packed:
                if self._begun and not self._gzip.eof:
                    raise ValueError("an archive ends within a record")
                return False

    def line_block(self, end: bytes) -> bytes | None:
        """All up to a mark, without it; None at the end of the file."""
        while (at := self._held.find(end)) < 0:
            if not self._more():
                if self._held:
                    raise ValueError("an archive ends within a record")
                return None
        found, self._held = self._held[:at], self._held[at + len(end) :]
        return found

    def take(self, size: int) -> Iterator[bytes]:
        """The next ``size`` bytes, piece by piece."""
        while size:
            if not self._held and not self._more():
                raise ValueError("an archive ends within a record")
            piece, self._held = self._held[:size], self._held[size:]
            size -= len(piece)
            yield piece


def _records(stream: _Stream) -> Iterator[tuple[dict[str, str], Iterator[bytes]]]:
    """Fields and payload pieces of each record; pieces must be used up before the next record."""
    while (head := stream.line_block(b"\r\n\r\n")) is not None:
        version, *lines = head.decode().split("\r\n")
        if not re.fullmatch(r"WARC/1\.\d", version):
            raise ValueError(f"not a record: {version[:40]!r}")
        fields = dict(line.split(": ", 1) for line in lines)
        http = stream.line_block(b"\r\n\r\n")
        yield fields, stream.take(int(fields["Content-Length"]) - len(http) - 4)
        if b"".join(stream.take(4)) != _END:
            raise ValueError("a record is longer than it says")


def read_archives(files: DataFrame, chunk_bytes: int = CHUNK_BYTES, with_data: bool = True) -> DataFrame:
    """Archives as a table of chunks: ``urn, type, page, uri, refers, declared, chunk, last, data, bytes, sha256``.

    ``declared`` is the digest that the header names; ``bytes`` and ``sha256`` are of what was read. A revisit is one chunk
    without data. Without ``with_data`` only the last chunk of each record comes, its data left out. In ``uri`` characters that
    an address cannot have are percent-encoded.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [*[("string", pa.string())] * 6, ("int", pa.int32()), ("boolean", pa.bool_()), ("binary", pa.binary()),
                 ("bigint", pa.int64()), ("string", pa.string())]
        rows: list[tuple] = []

        def batch() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, kinds, strict=True)], names)

        for b in batches:
            for file in b.column(0).to_pylist():
                system, name = _file_system(file)
                with system.open_input_stream(name, compression=None) as f:
                    for fields, pieces in _records(_Stream(f)):
                        head = tuple(fields.get(k) for k in ("WARC-Record-ID", "WARC-Type", "X-Page", "WARC-Target-URI", "WARC-Refers-To"))
                        head += (fields["WARC-Payload-Digest"].removeprefix("sha256:"),)
                        digest, size, held, chunk, waiting = hashlib.sha256(), 0, bytearray(), 0, 0
                        for piece in pieces:
                            digest.update(piece)
                            size += len(piece)
                            if not with_data:
                                continue
                            held += piece
                            while len(held) > chunk_bytes:
                                rows.append((*head, chunk, False, bytes(held[:chunk_bytes]), size - len(held) + chunk_bytes, None))
                                del held[:chunk_bytes]
                                chunk += 1
                                waiting += chunk_bytes
                                if waiting > 32 * chunk_bytes:
                                    yield batch()
                                    waiting = 0
                        data = bytes(held) if with_data and head[1] == "response" else None
                        rows.append((*head, chunk, True, data, size, digest.hexdigest()))
                        if len(rows) >= (64 if with_data else 4096):
                            yield batch()
        yield batch()

    schema = ("urn string, type string, page string, uri string, refers string, declared string, chunk int, last boolean, "
              "data binary, bytes bigint, sha256 string")
    names = [part.split()[0] for part in schema.split(", ")]
    n_files = max(1, files.count())
    found = files.select("file").repartition(n_files).mapInArrow(read, schema)
    return found.withColumn("page", F.url_decode(F.replace("page", F.lit("+"), F.lit("%2B"))))


def archive_pages(
    pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", uri_col: str | None = "url",
    least: int = LEAST_REVISIT, chunk_bytes: int = CHUNK_BYTES, file_bytes: int = FILE_BYTES, path: str | None = None,
) -> DataFrame:
    """Write one record per row and read the archives back: ``id_col, payload_bytes, payload_digest, record_type, refers_to``.

    Of records with equal payloads of at least ``least`` bytes the smallest id is a response, the others revisit it; null
    ids come last and are revisited as null. Of repeated rows one is the response. Null and empty payloads are responses of
    no bytes. Length and digest are those of the payload that was read, for a revisit of the record it refers to. A payload
    of any length is handled in chunks; an empty table writes no file and gives an empty result; further columns are ignored.
    """
    spark = pages.sparkSession
    chunks = chunk_table(pages, id_col, payload_col, uri_col, chunk_bytes)
    files = write_archives(chunks, revisits(chunks, least), path or shared_folder(spark, "warc"), file_bytes)
    found = settle(read_archives(files, with_data=False).select("urn", "type", "page", "refers", "declared", "bytes", "sha256"), "warc-read")

    def checked(read: str) -> Column:
        wrong = F.raise_error(F.lit("a payload differs from its digest"))
        return F.when(F.col("declared") == F.col(read), F.col(read)).otherwise(wrong).alias("sha256")

    stored = found.where("type = 'response'").select("urn", "page", "bytes", checked("sha256"))
    named = found.where("type = 'revisit'").select("refers").distinct()
    targets = stored.join(named, F.col("urn") == F.col("refers"), "left_semi").toDF("_urn", "_page", "_bytes", "_sha256")
    targets = settle(targets, "warc-targets")
    targets = F.broadcast(targets) if small_enough(targets, 256) else targets
    again = found.where("type = 'revisit'").join(targets, F.col("refers") == F.col("_urn"))
    kind = pages.schema[id_col].dataType
    out = stored.select("page", "bytes", "sha256", F.lit("response").alias("type"), F.lit(None).cast("string").alias("refers"))
    out = out.unionByName(again.select("page", F.col("_bytes").alias("bytes"), checked("_sha256"), "type", F.col("_page").alias("refers")))
    return out.select(
        F.col("page").cast(kind).alias(id_col), F.col("bytes").alias("payload_bytes"), F.col("sha256").alias("payload_digest"),
        F.col("type").alias("record_type"), F.col("refers").cast(kind).alias("refers_to"),
    )
