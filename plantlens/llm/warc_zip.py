"""WARC records in ZIP packages, written and read by ranges.

`write_archives` lets every task write its pages to ZIP files below the shared folder: a stored
member with one gzip-compressed WARC record per page, and a stored index of their offsets. A page
whose payload is that of others is written as a revisit of the one with the largest page_id, so the
payload is kept once. File names are new for every attempt, and the returned manifest has only
those of committed tasks; what a lost executor leaves behind is never read.

`read_archives` never unpacks a ZIP file. It reads the end record, the ZIP64 records if there are
any, and the central directory, locates the stored members behind their local headers, reads the
index, and deals ranges of about `RANGE_BYTES` to tasks, which read just those bytes. Files are
opened by their URI (local, HDFS or object store, as Arrow supports), not through the driver.

Null html is an empty payload; null urls come back as null. Rows with a null page_id are written as
responses and never referred to. Rows that repeat the largest page_id of a payload are all
responses. Extra columns are not archived. No pages give no archives and no records.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlens.llm.common import join_hot, slices, stored
from plantlens.session import shared_dir

ARCHIVE_BYTES = 256 << 20
RANGE_BYTES = 8 << 20
INDEXES_PER_TASK = 4
DATA_MEMBER, INDEX_MEMBER = "archive/data.warc.gz", "indexes/index.cdxj"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST_SCHEMA = "path string, n_records long, n_bytes long"
RECORD_SCHEMA = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, "
    "payload_digest string, payload binary, path string, offset long, length long"
)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# Records


def make_record(
    page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str
) -> bytes:
    """A WARC response, or a revisit record if `refers_to` is given."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    http += b"Content-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest_of(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        # A line break would end the header.
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def header_fields(head: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in head.decode().split("\r\n")[1:])
    return {name.lower(): value[1:] if value[:1] == " " else value for name, _, value in pairs}


def page_of(urn: str) -> int | None:
    number = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def parse_record(record: bytes) -> dict:
    """The fields of a record; the payload of a revisit is None, its length that of the original."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = header_fields(head)
    block = rest[: int(fields["content-length"])]
    if len(rest) != len(block) + 4:
        raise ValueError(f"record of {len(record)} bytes does not end where its header says")
    http, _, payload = block.partition(b"\r\n\r\n")
    size, digest = int(header_fields(http)["content-length"]), fields["warc-payload-digest"][5:]
    revisit = fields["warc-type"] == "revisit"
    if not revisit and (len(payload) != size or digest_of(payload) != digest):
        raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")
    return {
        "page_id": page_of(fields["warc-record-id"]),
        "url": fields.get("warc-target-uri"),
        "record_type": fields["warc-type"],
        "refers_to": page_of(fields["warc-refers-to"]) if revisit else None,
        "payload_bytes": size,
        "payload_digest": digest,
        "payload": None if revisit else payload,
    }


def compress(record: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


# Packages


class ArchiveWriter:
    """One ZIP file, written front to back."""

    def __init__(self, folder: str):
        self.path = f"{folder}/pages-{uuid.uuid4().hex}.wacz"
        system, path = fs.FileSystem.from_uri(folder)
        self.stream = system.open_output_stream(f"{path}/{self.path.rpartition('/')[2]}")
        self.zip = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.data = self.zip.open(member(DATA_MEMBER), "w", force_zip64=True)
        self.at, self.index = 0, []

    def add(self, page_id: int | None, record: bytes) -> None:
        packed = compress(record)
        self.data.write(packed)
        entry = {"page_id": page_id, "offset": self.at, "length": len(packed)}
        self.index.append(json.dumps(entry))
        self.at += len(packed)

    def close(self) -> tuple[str, int, int]:
        self.data.close()
        self.zip.writestr(member(INDEX_MEMBER), "\n".join(self.index))
        about = {"profile": "data-package", "resources": [DATA_MEMBER, INDEX_MEMBER]}
        self.zip.writestr(member("datapackage.json"), json.dumps(about))
        self.zip.close()
        self.stream.close()
        return self.path, len(self.index), self.at


def member(name: str) -> zipfile.ZipInfo:
    return zipfile.ZipInfo(name)


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    header_at: int


class ZipDirectory:
    """The central directory of a ZIP file, read by ranges through `read_at(offset, length)`."""

    def __init__(self, size: int, read_at):
        self.size, self.read_at = size, read_at
        self.members = {m.name: m for m in self._entries(*self._directory())}

    def _directory(self) -> tuple[int, int]:
        """Offset and length of the central directory."""
        tail_at = max(0, self.size - (1 << 16) - 22)
        tail = self.read_at(tail_at, self.size - tail_at)
        at = tail.rfind(b"PK\x05\x06", 0, len(tail) - 18)
        while at >= 0 and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail):
            at = tail.rfind(b"PK\x05\x06", 0, at)
        if at < 0:
            raise ValueError("not a ZIP file: no end record")
        length, offset = struct.unpack_from("<II", tail, at + 12)
        locator_at = tail_at + at - 20
        locator = self.read_at(locator_at, 20) if locator_at >= 0 else b""
        if locator[:4] == b"PK\x06\x07":
            record = self.read_at(struct.unpack_from("<Q", locator, 8)[0], 56)
            if record[:4] != b"PK\x06\x06":
                raise ValueError("the ZIP64 end record is not where its locator says")
            length, offset = struct.unpack_from("<QQ", record, 40)
        return offset, length

    def _entries(self, offset: int, length: int) -> Iterator[Member]:
        raw, at = self.read_at(offset, length), 0
        while at < len(raw):
            if raw[at : at + 4] != b"PK\x01\x02":
                raise ValueError("damaged central directory")
            method, packed, size = struct.unpack_from("<H8xII", raw, at + 10)
            n_name, n_extra, n_comment = struct.unpack_from("<HHH", raw, at + 28)
            header_at = struct.unpack_from("<I", raw, at + 42)[0]
            name_at = at + 46
            name = raw[name_at : name_at + n_name].decode()
            wide = self._zip64(raw[name_at + n_name : name_at + n_name + n_extra])
            # The 64-bit field has those values, in this order, that do not fit in 32 bits.
            size = wide.pop(0) if size == 0xFFFFFFFF else size
            packed = wide.pop(0) if packed == 0xFFFFFFFF else packed
            header_at = wide.pop(0) if header_at == 0xFFFFFFFF else header_at
            yield Member(name, method, packed, header_at)
            at = name_at + n_name + n_extra + n_comment

    @staticmethod
    def _zip64(extra: bytes) -> list[int]:
        at = 0
        while at + 4 <= len(extra):
            kind, length = struct.unpack_from("<HH", extra, at)
            if kind == 1:
                return list(struct.unpack_from(f"<{min(length // 8, 3)}Q", extra, at + 4))
            at += 4 + length
        return []

    def place(self, name: str) -> tuple[int, int]:
        """Offset and length of the bytes of a stored member."""
        entry = self.members[name]
        if entry.method != 0:
            raise ValueError(f"{name} is compressed; only stored members can be read by ranges")
        local = self.read_at(entry.header_at, 30)
        if local[:4] != b"PK\x03\x04":
            raise ValueError(f"no local header for {name}")
        n_name, n_extra = struct.unpack_from("<HH", local, 26)
        return entry.header_at + 30 + n_name + n_extra, entry.size


def open_file(path: str):
    """A file for ranged reads, and its size."""
    system, inner = fs.FileSystem.from_uri(path)
    file = system.open_input_file(inner)
    return file, file.size()


def ranges_of(path: str) -> Iterator[tuple[int, int, list[int]]]:
    """Ranges of the records of an archive: offset in the file, length, lengths of the records."""
    file, size = open_file(path)
    with file:
        directory = ZipDirectory(size, lambda at, n: file.read_at(n, at))
        base, _ = directory.place(DATA_MEMBER)
        at, length = directory.place(INDEX_MEMBER)
        index = file.read_at(length, at).decode()
    start, total, lengths = base, 0, []
    for line in index.split("\n") if index else []:
        lengths.append(json.loads(line)["length"])
        total += lengths[-1]
        if total >= RANGE_BYTES:
            yield start, total, lengths
            start, total, lengths = start + total, 0, []
    if lengths:
        yield start, total, lengths


# On Spark


def write_archives(
    pages: DataFrame, folder: str | None = None, least: int = 0, date: str = "1970-01-01T00:00:00Z"
) -> DataFrame:
    """Write the pages (page_id, url, html); the manifest of archives, stored.

    Equal payloads of at least `least` bytes are written once. `folder` must be reachable from all
    executors; by default it is a new one in the shared folder.
    """
    spark = pages.sparkSession
    folder = folder or shared_dir(spark, "warc")
    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    keyed = pages.select(F.col("page_id").cast("long"), "url", payload.alias("payload"))
    keyed = keyed.withColumn("digest", F.sha1("payload"))
    long_enough = (F.length("payload") >= least) & F.col("page_id").isNotNull()
    shared = stored(
        keyed.where(long_enough)
        .groupBy("digest")
        .agg(F.max("page_id").alias("original"), F.count("*").alias("n"))
        .where("n > 1"),
        "payloads",
    )
    marked = join_hot(keyed, shared, ["digest"], "n", F.col("page_id"), "left")
    again = long_enough & (F.col("original") != F.col("page_id"))
    rows = marked.select("page_id", "url", "payload", F.when(again, F.col("original")).alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, done = None, []
        for batch in batches:
            for part in slices(batch):
                for row in part.to_pylist():
                    writer = writer or ArchiveWriter(folder)
                    writer.add(row["page_id"], make_record(**row, date=date))
                    if writer.at >= ARCHIVE_BYTES:
                        done.append(writer.close())
                        writer = None
        if writer:
            done.append(writer.close())
        if done:
            columns = [pa.array(c) for c in zip(*done, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["path", "n_records", "n_bytes"])

    return stored(rows.mapInArrow(write, MANIFEST_SCHEMA), "manifest")


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """One row per record of the archives in `manifest`; see RECORD_SCHEMA."""

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                for start, length, lengths in ranges_of(path):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([path]),
                            pa.array([start], pa.int64()),
                            pa.array([length], pa.int64()),
                            pa.array([lengths], pa.list_(pa.int64())),
                        ],
                        names=["path", "start", "length", "lengths"],
                    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for span in batch.to_pylist():
                yield from read_range(span)

    def read_range(span: dict) -> Iterator[pa.RecordBatch]:
        file, _ = open_file(span["path"])
        with file:
            raw = file.read_at(span["length"], span["start"])
        rows, at = [], 0
        for length in span["lengths"]:
            row = parse_record(zlib.decompress(raw[at : at + length], 31))
            place = {"path": span["path"], "offset": span["start"] + at, "length": length}
            rows.append({**row, **place, **({} if payloads else {"payload": None})})
            at += length
        for begin in range(0, len(rows), 256):
            yield pa.RecordBatch.from_pylist(rows[begin : begin + 256], schema=RECORD_ARROW)

    # Rows stand for many bytes here, so partitions are counted by those, not by Spark.
    count, volume = manifest.agg(F.count("*"), F.sum("n_bytes")).first()
    paths = manifest.select("path").repartition(max(1, -(-count // INDEXES_PER_TASK)), "path")
    spans = paths.mapInArrow(locate, "path string, start long, length long, lengths array<long>")
    tasks = max(1, -(-(volume or 0) // RANGE_BYTES))
    return spans.repartition(tasks, "path", "start").mapInArrow(read, RECORD_SCHEMA)


RECORD_ARROW = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("payload", pa.binary()),
        ("path", pa.string()),
        ("offset", pa.int64()),
        ("length", pa.int64()),
    ]
)
