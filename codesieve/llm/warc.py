"""Normaliser for WARC archives that were compressed as one stream.

An archive whose records share one gzip stream can only be read from its beginning. The normaliser inflates such
a file once, as a stream, and rewrites every record as a gzip member of its own, with a sidecar index of offsets
beside the new file, so any record can be read by itself.

While it rewrites, it may turn responses into revisits: a revisit keeps the headers and names the record whose
payload it repeats. Which records do is decided from a narrow table of payload digests, never from payloads.

Files lie in the folder all executors share, under names that no other attempt of a task uses; only files named in
the table that a finished task wrote are ever read. Memory holds one buffer of a file, however long its records.

Defined results: a null payload is an empty one; a null page id is smaller than all others and its header is left
out; a null URL has no header; among records with the same page id and payload the last written is the response.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codesieve.llm.store import Store

ARCHIVE_BYTES = 16 << 20
LEVEL = 4
CHUNK = 1 << 16
DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORDS = "file string, record long, page_id long, payload_bytes long, payload_digest string"
FILES = "file string, index string, records long, bytes long"
READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def open_folder(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder given as a path or a URI, and the folder's path there."""
    if "://" in folder or folder.startswith("file:"):
        return fs.FileSystem.from_uri(folder)
    return fs.LocalFileSystem(), folder


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header(fields: list[tuple[str, str | None]]) -> bytes:
    lines = ["WARC/1.1", *[f"{name}: {value}" for name, value in fields if value is not None]]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def _fields(header: bytes) -> list[tuple[str, str]]:
    return [tuple(line.split(": ", 1)) for line in header.decode().split("\r\n")[1:] if line]


def _safe_url(url: str | None) -> str | None:
    """A URL that stays on its header line."""
    return url and re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def response(page_id: int | None, url: str | None, payload: bytes) -> bytes:
    """A whole response record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = _header(
        [
            ("WARC-Type", "response"),
            ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
            ("WARC-Date", DATE),
            ("WARC-Target-URI", _safe_url(url)),
            ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
            ("X-Page-Id", None if page_id is None else str(page_id)),
            ("Content-Type", "application/http; msgtype=response"),
            ("Content-Length", str(len(http) + len(payload))),
        ]
    )
    return b"".join((head, http, payload, b"\r\n\r\n"))


class Inflated:
    """Bytes of a gzip file of one or many members, read as one stream."""

    def __init__(self, source):
        self.source, self.buffer, self.inflate = source, bytearray(), zlib.decompressobj(31)

    def _more(self) -> bool:
        while True:
            data = self.inflate.unused_data or self.inflate.unconsumed_tail
            if self.inflate.eof:
                data = data or self.source.read(CHUNK)
                if not data:
                    return False
                self.inflate = zlib.decompressobj(31)
            else:
                data = data or self.source.read(CHUNK)
                if not data:
                    raise EOFError("the archive ends within a gzip member")
            out = self.inflate.decompress(bytes(data), 4 * CHUNK)
            if out:
                self.buffer += out
                return True

    def until(self, mark: bytes) -> bytes:
        """Bytes up to and with ``mark``; none at the end of the file."""
        seen = 0
        while (at := self.buffer.find(mark, seen)) < 0:
            seen = max(0, len(self.buffer) - len(mark) + 1)
            if not self._more():
                if self.buffer.strip():
                    raise EOFError("the archive ends within a header")
                return b""
        return self._take(at + len(mark))

    def _take(self, count: int) -> bytes:
        out = bytes(self.buffer[:count])
        del self.buffer[:count]
        return out

    def pieces(self, count: int) -> Iterator[bytes]:
        """The next ``count`` bytes, piece by piece."""
        while count:
            if not self.buffer and not self._more():
                raise EOFError("the archive ends within a record")
            piece = self._take(min(count, len(self.buffer)))
            count -= len(piece)
            yield piece


def _monolithic_writer(folder: str, archive_bytes: int) -> Callable:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = open_folder(folder)
        system.create_dir(root, recursive=True)
        out = packer = None
        name, written, record = "", 0, 0
        for batch in batches:
            rows = []
            for page_id, url, html in zip(*[batch.column(c).to_pylist() for c in ("page_id", "url", "html")]):
                if out is None:
                    name, written, record = f"crawl-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out, packer = system.open_output_stream(f"{root}/{name}", compression=None), zlib.compressobj(LEVEL, wbits=31)
                payload = (html or "").encode()
                data = response(page_id, url, payload)
                out.write(packer.compress(data))
                rows.append((name, record, page_id, len(payload), digest(payload)))
                written, record = written + len(data), record + 1
                if written >= archive_bytes:
                    out.write(packer.flush())
                    out.close()
                    out = None
            columns = list(zip(*rows)) or [()] * 5
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            names = ["file", "record", "page_id", "payload_bytes", "payload_digest"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
        if out is not None:
            out.write(packer.flush())
            out.close()

    return write


def write_monolithic(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``pages`` (``page_id, url, html``) as archives of one gzip stream each; one row per record.

    The table must be written once before it is used: each run of it makes files anew.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return rows.mapInArrow(_monolithic_writer(folder, archive_bytes), RECORDS)


def revisits(records: DataFrame) -> DataFrame:
    """The records whose payload a record with a larger page id holds, as ``file, record, refers_to``."""
    place = F.struct("page_id", "file", "record")
    last = records.groupBy("payload_digest", "payload_bytes").agg(F.max(place).alias("last"), F.count("*").alias("n"))
    met = records.join(last.where("n > 1"), ["payload_digest", "payload_bytes"])
    other = ~((F.col("file") == F.col("last.file")) & (F.col("record") == F.col("last.record")))
    return met.where(other).select("file", "record", F.col("last.page_id").alias("refers_to"))


def _rewriter(folder: str) -> Callable:
    def revisit(fields: list[tuple[str, str]], http: bytes, refers_to: int | None) -> bytes:
        kept = [(k, v) for k, v in fields if k not in ("WARC-Type", "Content-Length")]
        first = [("WARC-Type", "revisit"), ("WARC-Profile", REVISIT_PROFILE)]
        last = [("X-Refers-To-Page-Id", None if refers_to is None else str(refers_to)), ("Content-Length", str(len(http)))]
        return _header(first + kept + last) + http

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = open_folder(folder)
        for batch in batches:
            for row in batch.to_pylist():
                repeats = {r["record"]: r["refers_to"] for r in row["revisits"] or ()}
                name = row["file"].replace("crawl-", f"records-{uuid.uuid4().hex[:8]}-")
                index, offset, record = [], 0, 0
                with system.open_input_stream(f"{root}/{row['file']}", compression=None) as source, system.open_output_stream(
                    f"{root}/{name}", compression=None
                ) as out:
                    stream = Inflated(source)
                    while header := stream.until(b"\r\n\r\n"):
                        fields, size, start = _fields(header), 0, offset
                        length = int(dict(fields)["Content-Length"])
                        packer = zlib.compressobj(LEVEL, wbits=31)
                        if record in repeats:
                            http = stream.until(b"\r\n\r\n")
                            for _ in stream.pieces(length - len(http)):
                                pass
                            parts = iter([revisit(fields, http, repeats[record])])
                        else:
                            out_header = packer.compress(header)
                            out.write(out_header)
                            offset += len(out_header)
                            parts = stream.pieces(length)
                        for part in parts:
                            packed = packer.compress(part)
                            out.write(packed)
                            offset += len(packed)
                        b"".join(stream.pieces(4))
                        packed = packer.compress(b"\r\n\r\n") + packer.flush()
                        out.write(packed)
                        offset += len(packed)
                        size = offset - start
                        index.append(f"{record}\t{start}\t{size}\n")
                        record += 1
                sidecar = f"{name}.idx"
                with system.open_output_stream(f"{root}/{sidecar}", compression=None) as out:
                    out.write("".join(index).encode())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name]), pa.array([sidecar]), pa.array([record], pa.int64()), pa.array([offset], pa.int64())],
                    ["file", "index", "records", "bytes"],
                )

    return rewrite


def _one_each(files: DataFrame) -> DataFrame:
    """A task for each row of a small table of files."""
    return files.repartitionByRange(max(1, files.count()), "file")


def normalise(files: DataFrame, folder: str) -> DataFrame:
    """Rewrite archives (``file, revisits``) with one member per record and a sidecar index; one row per new file."""
    return _one_each(files).mapInArrow(_rewriter(folder), FILES)


def _reader(folder: str) -> Callable:
    def parse(member: bytes) -> tuple:
        data = zlib.decompress(member, 31)
        header, _, block = data.partition(b"\r\n\r\n")
        fields = dict(_fields(header))
        http, _, payload = block[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
        number = lambda name: int(fields[name]) if name in fields else None
        claimed = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        length = int(re.search(rb"(?m)^Content-Length: (\d+)", http)[1])
        if fields["WARC-Type"] == "response" and (digest(payload), len(payload)) != (claimed, length):
            raise ValueError(f"payload of {fields['WARC-Record-ID']} differs from its digest")
        return number("X-Page-Id"), length, claimed, fields["WARC-Type"], number("X-Refers-To-Page-Id")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = open_folder(folder)
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        for batch in batches:
            for row in batch.to_pylist():
                with system.open_input_stream(f"{root}/{row['index']}", compression=None) as source:
                    entries = [tuple(map(int, line.split(b"\t"))) for line in source.read().splitlines()]
                with system.open_input_file(f"{root}/{row['file']}") as source:
                    records = [parse(source.read_at(size, start)) for _, start, size in entries]
                columns = list(zip(*records)) or [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return read


def read_back(files: DataFrame, folder: str) -> DataFrame:
    """Every record of normalised files (``file, index``), each read by its offset and checked against its digest."""
    return _one_each(files).mapInArrow(_reader(folder), READ)


def round_trip(spark: SparkSession, pages: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write pages as monolithic archives, normalise these with revisits, and read the records back.

    Writes archives and tables to the shared folder when it is called.
    """
    store = Store(spark, "warc")
    folder = store.path("archives")
    records = store.keep(write_monolithic(pages, folder, archive_bytes), "records")
    repeated = revisits(records).groupBy("file").agg(F.collect_list(F.struct("record", "refers_to")).alias("revisits"))
    files = store.keep(records.select("file").distinct().join(repeated, "file", "left"), "files")
    normal = store.keep(normalise(files, folder), "normal")
    return read_back(normal, folder)
