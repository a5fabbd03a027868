"""Spark data source for crawl archives: spark.read.format("warc").load(path).

An archive is read in byte ranges. Crawl archives are a gzip member per record: a range reads the
members that start in it, beginning with the first place where a member opens with a record. An
archive that is one member, or not compressed, is one range. Records stream through, one in memory
at a time.

Bytes of a record can look like a member too, where it holds an archive of its own. Such a chain of
members breaks where the inner archive ends; the range then finds its true start by following the
members from the start of the file.
"""

from __future__ import annotations

import gzip
import io
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "id string, url string, date timestamp, file_path string, html string"
BATCH_BYTES = 2 << 20


SPLIT_BYTES = 128 << 20
READ_BYTES = 1 << 20
MEMBER = b"\x1f\x8b\x08"


class ArchiveRange(InputPartition):
    def __init__(self, path: str, start: int, end: int | None):
        self.path, self.start, self.end = path, start, end


class Members(io.RawIOBase):
    """The decompressed gzip members that start in start .. end - 1.

    The last one read starts at `opened`; `at` is the place after it.
    """

    def __init__(self, file, start: int, end: int):
        file.seek(start)
        self.file, self.at, self.end, self.opened = file, start, end, start
        self.pending, self.unzip = b"", None

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while True:
            if not self.pending:
                self.pending = self.file.read(READ_BYTES)
            if self.unzip is None:
                padded = len(self.pending)
                self.pending = self.pending.lstrip(b"\0")
                self.at += padded - len(self.pending)
                if padded and not self.pending:
                    continue
                if not self.pending or self.at >= self.end:
                    return 0
                self.opened, self.unzip = self.at, zlib.decompressobj(31)
            out = self.unzip.decompress(self.pending, len(buffer))
            if not self.pending and not out and not self.unzip.eof:
                raise EOFError("the archive is cut off")
            rest = self.unzip.unused_data if self.unzip.eof else self.unzip.unconsumed_tail
            self.at += len(self.pending) - len(rest)
            self.pending = rest
            if self.unzip.eof:
                self.unzip = None
            if out:
                buffer[: len(out)] = out
                return len(out)


def opens_record(file, at: int) -> bool:
    file.seek(at)
    try:
        return zlib.decompressobj(31).decompress(file.read(1 << 16), 5) == b"WARC/"
    except zlib.error:
        return False


def first_member(file, start: int, end: int) -> int | None:
    """The first place from `start` on, and before `end`, where a member opens with a record."""
    while start < end:
        file.seek(start)
        data = file.read(min(READ_BYTES, end - start) + len(MEMBER) - 1)
        found = data.find(MEMBER)
        while found >= 0:
            if opens_record(file, start + found):
                return start + found
            found = data.find(MEMBER, found + 1)
        start += READ_BYTES
    return None


def true_start(file, start: int, split: int) -> int:
    """The first member from `start` on, found by following all members before it.

    The range before may have taken the inside of a member that covers all of it for members.
    """
    before = Members(file, 0, start)
    room = memoryview(bytearray(READ_BYTES))
    while before.readinto(room):
        pass
    if before.opened < start - split:
        raise ValueError("a record with an archive of its own is longer than a range: set splitBytes to 0")
    return before.at


def _headers(lines: Iterator[bytes]) -> dict[str, str]:
    """Header lines up to the empty one, names in lower case."""
    headers: dict[str, str] = {}
    for line in lines:
        if not line.strip():
            break
        name, _, value = line.decode("utf-8", "replace").partition(":")
        headers[name.strip().lower()] = value.strip()
    return headers


def records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record, framed by its Content-Length."""
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue  # blank lines between records
        headers = _headers(iter(stream.readline, b""))
        length = int(headers.get("content-length", 0))
        block = stream.read(length)
        if len(block) < length:
            raise EOFError(f"record {headers.get('warc-record-id')} is cut off")
        yield headers, block


def _unchunked(body: bytes) -> bytes:
    out, rest = [], io.BytesIO(body)
    while size := rest.readline().split(b";")[0].strip():
        count = int(size, 16)
        if count == 0:
            break
        out.append(rest.read(count))
        rest.readline()
    return b"".join(out)


def http_body(block: bytes) -> bytes:
    """Body of an HTTP response record, transfer and content encodings undone."""
    if not block.startswith(b"HTTP/"):
        return block
    stream = io.BytesIO(block)
    stream.readline()
    headers = _headers(iter(stream.readline, b""))
    body = stream.read()
    try:
        if headers.get("transfer-encoding", "").lower() == "chunked":
            body = _unchunked(body)
    except ValueError:
        pass  # crawlers often store the decoded body under the original header
    try:
        encoding = headers.get("content-encoding", "").lower()
        if encoding in ("gzip", "x-gzip"):
            body = gzip.decompress(body)
        elif encoding == "deflate":
            body = zlib.decompress(body)
    except (OSError, EOFError, zlib.error):
        pass  # same
    return body


def file_system(path: str):
    """(file system, path in it) on any file system Arrow knows."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def open_range(path: str, file, start: int, end: int | None) -> io.BufferedIOBase:
    if not path.endswith(".gz"):
        return io.BufferedReader(file)
    if end is None:
        return gzip.open(file)
    return io.BufferedReader(Members(file, start, end))


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = [p for p in options.get("paths", options.get("path", "")).split("\n") if p]
        self.limit = int(options.get("limit", -1))
        self.split = int(options.get("splitBytes", SPLIT_BYTES))

    def partitions(self) -> list[ArchiveRange]:
        """Ranges of each archive; of the files the driver sees their sizes alone."""
        ranges = []
        for path in self.paths:
            size = 0
            if self.split > 0 and path.endswith(".gz"):
                system, inner = file_system(path)
                size = system.get_file_info(inner).size or 0
            if size <= self.split:
                ranges.append(ArchiveRange(path, 0, None))
            else:
                for start in range(0, size, self.split):
                    ranges.append(ArchiveRange(path, start, min(start + self.split, size)))
        return ranges

    def read(self, partition: ArchiveRange) -> Iterator[pa.RecordBatch]:
        system, inner = file_system(partition.path)
        if partition.end is None:
            with system.open_input_stream(inner, compression=None, buffer_size=READ_BYTES) as file:
                yield from self.batches(partition, file, 0)
            return
        with system.open_input_file(inner) as file:
            start, end = partition.start, partition.end
            at = first_member(file, start, end) if start else 0
            if at is None:
                return
            handed_on = False
            try:
                for batch in self.batches(partition, file, at):
                    yield batch
                    handed_on = True
            except (zlib.error, EOFError):
                actual = true_start(file, start, self.split) if start else 0
                if actual == at or handed_on:
                    raise
            else:
                return
            if actual < end:
                yield from self.batches(partition, file, actual)

    def batches(self, partition: ArchiveRange, file, at: int) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("id", pa.string()), ("url", pa.string()), ("date", pa.timestamp("us", tz="UTC")),
                ("file_path", pa.string()), ("html", pa.string()),
            ]
        )
        rows, size, left = [], 0, self.limit
        for headers, block in records(open_range(partition.path, file, at, partition.end)):
            if left == 0:
                break
            if headers.get("warc-type") != "response":
                continue
            html = http_body(block).decode("utf-8", "ignore")
            date = headers.get("warc-date")
            rows.append(
                {
                    "id": headers.get("warc-record-id"),
                    "url": headers.get("warc-target-uri"),
                    "date": date and datetime.fromisoformat(date).astimezone(timezone.utc),
                    "file_path": partition.path,
                    "html": html,
                }
            )
            left -= 1
            size += len(html)
            if size >= BATCH_BYTES:
                yield pa.RecordBatch.from_pylist(rows, schema)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


class ArchiveSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(self.options)


def read_warc(
    spark: SparkSession, paths: list[str], limit: int = -1, split_bytes: int = SPLIT_BYTES
) -> DataFrame:
    """Response records of the archives; `limit` caps the records read, -1 reads all.

    A compressed archive of more than `split_bytes` is several ranges, 0 keeps files whole. No
    task reads on after `limit` records.
    """
    spark.dataSource.register(ArchiveSource)
    reader = spark.read.format("warc").option("paths", "\n".join(paths))
    df = reader.option("limit", limit).option("splitBytes", split_bytes).load()
    return df if limit < 0 else df.limit(limit)
