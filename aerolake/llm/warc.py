"""WARC archives as a PySpark Python data source (operator 10).

``plan_records`` decides which pages are written in full and which as revisits of
an equal payload; ``write_warc`` and ``read_warc`` use the data source ``warc``.

Writing: each task writes gzip members, one a record, to a temporary name of its
own; only the commit on the driver gives committed files their final names, so
lost tasks and repeated attempts leave nothing behind.  A member's extra field
``sl`` holds its lengths, as other archive writers do.

Reading: files are planned into partitions by size.  Record-type and header
predicates are pushed to the reader, which inflates and parses a record's headers
first and goes on to the next member, without inflating the payload, when the
record is not wanted or payloads were not asked for (option ``payload``).  Plain
.warc files and members without lengths are read as well.

Files are opened through ``pyarrow.fs``, so a path may be any store it knows.

Defined results: a null payload is empty; a null url or id leaves its header out
(null when read).  Of equal payloads from ``MIN_REVISIT_BYTES`` on, every record
of the largest id is a response, the others revisit it; a record without id
revisits too, unless no equal payload has an id.
"""

from __future__ import annotations

import base64
import io
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull,
    StringStartsWith, WriterCommitMessage)

from aerolake.llm.common import stored

MIN_REVISIT_BYTES = 1000
PARTITION_BYTES = 64 << 20      # of archive that one reading task gets, about
FILE_BYTES = 256 << 20          # a writing task starts another file beyond this
BATCH_BYTES = 8 << 20
HEAD_BYTES = 4096               # inflated at first, to find the headers
LEVEL = 1                       # of compression

VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"   # when a page has no date of its own
ID_URN = "urn:x-page:"

RECORD_SCHEMA = ("record_type string, record_id string, target_uri string, record_date string, "
                 "payload_digest string, refers_to string, payload_bytes bigint, headers map<string,string>, "
                 "payload binary")
ARROW = pa.schema([
    ("record_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()),
    ("record_date", pa.string()), ("payload_digest", pa.string()), ("refers_to", pa.string()),
    ("payload_bytes", pa.int64()), ("headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())])
HEADER_OF = {"record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri",
             "record_date": "warc-date", "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to"}


# --- records ---------------------------------------------------------------

def _clean(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record_bytes(record_type: str, record_id: str | None, target_uri: str | None, digest: str,
                 refers_to: str | None, payload_bytes: int, payload: bytes, date: str = DATE) -> bytes:
    """One uncompressed record: an HTTP response, or the headers alone of a revisit."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n").encode()
    block = http + payload if record_type != "revisit" else http
    name = record_id or uuid.uuid5(uuid.NAMESPACE_URL, f"{digest} {target_uri}").urn
    head = [f"WARC-Type: {record_type}", f"WARC-Record-ID: <{name}>", f"WARC-Date: {date}"]
    if target_uri is not None:
        head.append(f"WARC-Target-URI: {_clean(target_uri)}")
    head.append(f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}")
    if record_type == "revisit":
        head += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return VERSION + b"\r\n" + "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(raw: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, -15)
    body = packer.compress(raw) + packer.flush()
    total = 10 + 2 + 12 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, total, len(raw))
    return (b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + body
            + struct.pack("<II", zlib.crc32(raw), len(raw) & 0xFFFFFFFF))


def parse_headers(head: bytes) -> dict[str, str]:
    lines = head.split(b"\r\n")
    if not lines[0].startswith(b"WARC/"):
        raise ValueError(f"not a WARC record: {head[:60]!r}")
    out: dict[str, str] = {}
    last = None
    for line in lines[1:]:
        if line[:1] in (b" ", b"\t") and last:      # a folded line
            out[last] += " " + line.decode("utf-8", "replace").strip()
            continue
        name, _, value = line.decode("utf-8", "replace").partition(":")
        last = name.strip().lower()
        out[last] = value.strip()
    return out


def _column(name: str, headers: dict[str, str]) -> str | None:
    value = headers.get(HEADER_OF[name])
    if value is None:
        return None
    if name in ("record_id", "refers_to"):
        return value.strip("<>")
    if name == "payload_digest" and value.lower().startswith("sha1:"):
        digest = value[5:]
        return base64.b32decode(digest.upper()).hex() if len(digest) == 32 else digest.lower()
    return value


# --- reading one file ------------------------------------------------------

class _Source(io.RawIOBase):
    """A pyarrow file for io.BufferedReader."""

    def __init__(self, file):
        self.file = file

    def readable(self):
        return True

    def seekable(self):
        return True

    def readinto(self, into):
        data = self.file.read(len(into))
        into[:len(data)] = data
        return len(data)

    def seek(self, at, whence=0):
        self.file.seek(at, whence)
        return self.file.tell()

    def tell(self):
        return self.file.tell()


def _exactly(f, n: int) -> bytes:
    data = f.read(n)
    if len(data) != n:
        raise ValueError("the archive ends within a record")
    return data


class _Member:
    """The gzip member at the current place of ``f``: inflated only as far as asked."""

    def __init__(self, f):
        self.f = f
        self.start = f.tell()
        fixed = _exactly(f, 10)
        self.end = None
        if fixed[3] & 4:
            extra = _exactly(f, struct.unpack("<H", _exactly(f, 2))[0])
            while len(extra) >= 4:
                n = struct.unpack("<H", extra[2:4])[0]
                if extra[:2] == b"sl" and n == 8:
                    self.end = self.start + struct.unpack("<I", extra[4:8])[0]
                extra = extra[4 + n:]
        f.seek(self.start)
        self.inflate = zlib.decompressobj(31)
        self.rest = b""

    def read(self, n: int) -> bytes:
        out = []
        while n > 0 and not self.inflate.eof:
            if not self.rest:
                self.rest = self.f.read(1 << 16)
                if not self.rest:
                    raise ValueError("the archive ends within a record")
            data = self.inflate.decompress(self.rest, n)
            self.rest = self.inflate.unconsumed_tail
            out.append(data)
            n -= len(data)
        return b"".join(out)

    def close(self) -> None:
        """Go to the next member; without a known end the rest must be inflated."""
        if self.end is None:
            while not self.inflate.eof:
                self.read(1 << 20)
            self.end = self.f.tell() - len(self.inflate.unused_data)
        self.f.seek(self.end)


class _Plain:
    """A record that is not compressed."""

    def __init__(self, f):
        self.f, self.end = f, None

    def read(self, n: int) -> bytes:
        return self.f.read(n)

    def close(self) -> None:
        self.f.seek(self.end)


def records(f, wanted, payloads: bool) -> Iterator[tuple[dict[str, str], int | None, bytes | None]]:
    """(headers, payload bytes, payload) of the records of a file whose headers
    ``wanted`` accepts; payload is None unless ``payloads``."""
    while True:
        first = f.read(2)
        while first in (b"\r\n", b"\n\r", b"\n"):       # between plain records
            first = f.read(2)
        if not first:
            return
        f.seek(-len(first), 1)
        start = f.tell()
        record = _Member(f) if first == b"\x1f\x8b" else _Plain(f)
        head = record.read(HEAD_BYTES)
        while (at := head.find(b"\r\n\r\n")) < 0:
            more = record.read(HEAD_BYTES)
            if not more:
                raise ValueError(f"no end of headers in the record at {start}")
            head += more
        headers = parse_headers(head[:at])
        length = int(headers.get("content-length", 0))
        if isinstance(record, _Plain):
            record.end = start + at + 4 + length
        size = payload = None
        if accepted := wanted(headers):
            block = head[at + 4:]
            http = headers.get("content-type", "").startswith("application/http")
            if http:
                while (cut := block.find(b"\r\n\r\n", 0, length)) < 0 and len(block) < length:
                    more = record.read(min(HEAD_BYTES, length - len(block)))
                    if not more:
                        raise ValueError(f"the record at {start} ends early")
                    block += more
                cut = cut + 4 if cut >= 0 else min(len(block), length)
                told = re.search(rb"(?im)^content-length:\s*(\d+)", block[:cut])
                size = int(told[1]) if told else length - cut
            else:
                cut, size = 0, length
            if payloads and headers.get("warc-type") != "revisit":
                if len(block) < length:
                    block += record.read(length - len(block))
                if len(block) < length:
                    raise ValueError(f"the record at {start} ends early")
                payload = block[cut:length]
                size = len(payload)
        record.close()
        if accepted:
            yield headers, size, payload


# --- data source -----------------------------------------------------------

@dataclass
class FilePartition(InputPartition):
    files: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payloads: bool, partition_bytes: int):
        self.path, self.payloads, self.partition_bytes = path, payloads, partition_bytes
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if name in HEADER_OF and isinstance(f, EqualTo):
                self.tests.append((name, "in", (f.value,)))
            elif name in HEADER_OF and isinstance(f, In):
                self.tests.append((name, "in", tuple(f.value)))
            elif name in HEADER_OF and isinstance(f, StringStartsWith):
                self.tests.append((name, "prefix", f.value))
            elif name in HEADER_OF and isinstance(f, IsNotNull):
                self.tests.append((name, "there", None))
            else:
                yield f

    def wanted(self, headers: dict[str, str]) -> bool:
        for name, kind, value in self.tests:
            have = _column(name, headers)
            if have is None or kind == "in" and have not in value or kind == "prefix" and not have.startswith(value):
                return False
        return True

    def partitions(self) -> list[FilePartition]:
        fs, root = pyarrow.fs.FileSystem.from_uri(self.path)
        info = fs.get_file_info(root)
        found = [info] if info.is_file else fs.get_file_info(pyarrow.fs.FileSelector(root, allow_not_found=True))
        files = sorted((x.path, x.size) for x in found
                       if x.is_file and re.search(r"\.warc(\.gz)?$", x.path) and not x.base_name.startswith(("_", ".")))
        parts: list[FilePartition] = []
        room = 0
        for path, size in files:
            if not parts or size > room:
                parts.append(FilePartition([]))
                room = self.partition_bytes
            parts[-1].files.append(path)
            room -= size
        return parts or [FilePartition([])]

    def read(self, partition: FilePartition) -> Iterator[pa.RecordBatch]:
        fs, _ = pyarrow.fs.FileSystem.from_uri(self.path)
        rows, held = [], 0
        for path in partition.files:
            with fs.open_input_file(path) as file:
                for headers, size, payload in records(io.BufferedReader(_Source(file), 1 << 20), self.wanted, self.payloads):
                    rows.append({**{name: _column(name, headers) for name in HEADER_OF}, "payload_bytes": size,
                                 "headers": list(headers.items()), "payload": payload})
                    held += len(payload or b"") + 1000
                    if held > BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, ARROW)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, ARROW)


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class WarcWriter(DataSourceArrowWriter):
    """Rows (record_type, record_id, target_uri, payload_digest, refers_to,
    payload_bytes, payload, optionally record_date) to one or more files a task."""

    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path, overwrite
        self.run = uuid.uuid4().hex

    def _places(self):
        fs, root = pyarrow.fs.FileSystem.from_uri(self.path)
        return fs, root, f"{root}/_temporary-{self.run}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        fs, _, temporary = self._places()
        fs.create_dir(temporary, recursive=True)
        names: list[str] = []
        out = None
        for batch in batches:
            columns = {n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names)}
            dates = columns.get("record_date") or [None] * batch.num_rows
            for kind, name, uri, digest, refers, size, payload, date in zip(
                    columns["record_type"], columns["record_id"], columns["target_uri"], columns["payload_digest"],
                    columns["refers_to"], columns["payload_bytes"], columns["payload"], dates):
                if out is None or out.tell() > FILE_BYTES:
                    if out is not None:
                        out.close()
                    names.append(f"{uuid.uuid4().hex}.warc.gz")
                    out = fs.open_output_stream(f"{temporary}/{names[-1]}", compression=None)
                out.write(gzip_member(record_bytes(kind, name, uri, digest, refers, size, payload or b"", date or DATE)))
        if out is not None:
            out.close()
        return Written(names)

    def commit(self, messages: list[Written | None]) -> None:
        fs, root, temporary = self._places()
        fs.create_dir(root, recursive=True)
        before = [x for x in fs.get_file_info(pyarrow.fs.FileSelector(root))
                  if x.is_file and re.search(r"\.warc(\.gz)?$", x.path)] if self.overwrite else []
        for message in messages:
            for name in message.files if message else ():
                fs.move(f"{temporary}/{name}", f"{root}/part-{name}")
        for x in before:
            fs.delete_file(x.path)
        self.abort(messages)

    def abort(self, messages) -> None:
        fs, _, temporary = self._places()
        if fs.get_file_info(temporary).type != pyarrow.fs.FileType.NotFound:
            fs.delete_dir(temporary)


class WarcDataSource(DataSource):
    """``spark.read.format("warc")`` with options path, payload (true or false) and
    partition_bytes; ``df.write.format("warc")`` with path."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return RECORD_SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], self.options.get("payload", "true").lower() == "true",
                          int(self.options.get("partition_bytes", PARTITION_BYTES)))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def write_warc(rows: DataFrame, path: str, mode: str = "append") -> None:
    register(rows.sparkSession)
    rows.write.format("warc").mode(mode).option("path", path).save()


def read_warc(spark: SparkSession, path: str, payload: bool = True, **options) -> DataFrame:
    register(spark)
    reader = spark.read.format("warc").option("path", path).option("payload", str(payload).lower())
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader.load()


# --- pages to records ------------------------------------------------------

def plan_records(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``pages`` (page_id, url, html) as rows for the writer.

    The payloads are shuffled once, by page; what is grouped by payload are
    digests and ids, combined map-side."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    light = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.sha1(payload).alias("digest"),
                         F.octet_length(payload).cast("bigint").alias("n")).where(F.col("n") >= min_bytes)
    holders = stored(light.groupBy("digest").agg(F.max("page_id").alias("holder"), F.count("*").alias("copies")).where(
        "copies > 1 and holder is not null").select("digest", "holder"), "warc-holders")
    revisits = stored(light.join(holders, "digest").where("page_id is null or page_id <> holder").select(
        F.col("page_id").alias("_id"), F.col("digest").alias("_digest"), "holder").distinct(), "warc-revisits")
    full = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", payload.alias("payload")).select(
        "*", F.sha1("payload").alias("payload_digest"), F.octet_length("payload").cast("bigint").alias("payload_bytes"))
    same = F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("payload_digest") == F.col("_digest"))
    urn = lambda c: F.concat(F.lit(ID_URN), F.col(c).cast("string"))
    return full.join(revisits, same, "left").select(
        F.when(F.col("holder").isNull(), "response").otherwise("revisit").alias("record_type"),
        urn("page_id").alias("record_id"), F.col("url").alias("target_uri"), "payload_digest",
        urn("holder").alias("refers_to"), "payload_bytes",
        F.when(F.col("holder").isNull(), F.col("payload")).alias("payload"))


def page_id_of(col: str) -> F.Column:
    return F.when(F.col(col).startswith(ID_URN), F.substring(col, len(ID_URN) + 1, 30).cast("bigint"))
