"""Operator 2, WARC archives, by way of a converter of legacy ARC archives.

ARC files begin with a version block, whose body names the version. A version 1 record has the header line
`URL IP date type length`, a version 2 record `URL IP date type result checksum location offset file length`; the declared
length says where the content ends. For each record the converter makes what WARC wants and ARC lacks: a record identifier,
an ISO timestamp, the record type, and the digests of payload and block.

Steps, each a Spark job whose rows are small (file, offset, key, digest); contents stay in the archives:

1. `write_arc`: each task writes archives of its own, one gzip member a record.
2. `index_arc`: each archive is scanned once; a row per record with its place and the digest of its payload.
3. `revisits`: of records with equal payloads the one with the least key is the response, the others revisit it. Groups
   are combined before the shuffle, so a payload that a third of all pages have is one row of each task.
4. `convert_arc`: the index, sorted by place, is read in ranges; each task writes one WARC archive.
5. `read_warc`: each archive is parsed again.

Tasks write under names of their own into the shared folder and hand over the names; only the names that Spark has
committed are read, so a task that is lost or runs twice leaves a file that nobody reads. Files are opened through
pyarrow's file systems, so the shared folder may be any of those (local or NFS, HDFS, object stores).

Payloads count as equal when their SHA-1 and their length are. A very long payload is one record and held whole by its task.

Defined results: a null payload is empty; empty payloads are equal like any others (`least` sets from how many bytes on);
a null key makes a response that nothing refers to; rows with the same key and payload leave one response; a null URL is
`about:blank`, and characters that a header line cannot hold are percent-encoded; no rows give no archives and no rows;
extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import stored, workspace

_V1 = ("url", "ip", "date", "type", "length")
_V2 = ("url", "ip", "date", "type", "result", "checksum", "location", "offset", "file", "length")
_KEY = b"X-Page-Id"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_LEVEL = 4


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _member(data: bytes) -> bytes:
    z = zlib.compressobj(_LEVEL, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


_GIVEN = 1 << 15


class _Members:
    """Reads a file's gzip members (or, if it is not compressed, its bytes) as one stream that knows where members begin."""

    def __init__(self, file) -> None:
        self.file, self.raw, self.used, self.data, self.at = file, b"", 0, b"", 0
        self.start = self.read_to = 0  # offsets in the file: of the member that gave the last data, and of `raw`
        self.plain: bool | None = None
        self.z = None

    def _more(self) -> bool:
        if self.used == len(self.raw):
            self.raw, self.used = self.file.read(1 << 20), 0
            if not self.raw:
                return False
        if self.plain is None:
            self.plain = self.raw[:2] != b"\x1f\x8b"
        if self.plain:
            fresh, self.used = self.raw, len(self.raw)
        else:
            if self.z is None:
                self.z, self.start = zlib.decompressobj(31), self.read_to
            # a little at a time, since what follows a member's end is copied
            given = self.raw[self.used : self.used + _GIVEN]
            fresh = self.z.decompress(given)
            taken = len(given) - len(self.z.unused_data)
            self.used += taken
            self.read_to += taken
            if self.z.eof:
                self.z = None
        self.data = self.data[self.at :] + fresh
        self.at = 0
        return True

    def line(self) -> bytes | None:
        """The next line without its end; None at the end of the file."""
        while (end := self.data.find(b"\n", self.at)) < 0:
            if not self._more():
                return None
        out = self.data[self.at : end]
        self.at = end + 1
        return out.rstrip(b"\r")

    def take(self, n: int) -> bytes:
        parts, missing = [], n
        while True:  # each piece is taken whole before the next one is read, so that none is copied twice
            part = self.data[self.at : self.at + missing]
            self.at += len(part)
            missing -= len(part)
            parts.append(part)
            if not missing or not self._more():
                break
        if missing:
            raise ValueError("a record ends before its declared length")
        return b"".join(parts)


def parse_arc(file) -> Iterator[tuple[dict, bytes, int]]:
    """(header, content, offset of the gzip member) of each record after the version block."""
    stream, names = _Members(file), None
    while (line := stream.line()) is not None:
        if not line:
            continue
        if names is None:
            if not line.startswith(b"filedesc:"):
                raise ValueError("an ARC file begins with a version block")
            block = stream.take(int(line.rsplit(b" ", 1)[1]))
            names = _V2 if block.startswith(b"2") else _V1
            continue
        fields = line.decode("utf-8", "replace").rsplit(" ", len(names) - 1)
        if len(fields) != len(names):
            raise ValueError("a header line lacks fields of its version")
        header = dict(zip(names, fields, strict=True))
        yield header, stream.take(int(header["length"])), stream.start


def arc_version_block(version: int, name: str, date: str) -> bytes:
    body = f"{version} 0 corpus\n".encode() + (
        b"URL IP-address Archive-date Content-type Archive-length\n"
        if version == 1
        else b"URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length\n"
    )
    more = "" if version == 1 else "200 - - 0 " + name + " "
    return f"filedesc://{name} 0.0.0.0 {date} text/plain {more}{len(body)}\n".encode() + body + b"\n"


def arc_record(version: int, url: str, date: str, content: bytes, name: str = "-", offset: int = 0, ip: str = "0.0.0.0") -> bytes:
    more = "" if version == 1 else f"200 {sha1_base32(content)} - {offset} {name} "
    return f"{url} {ip} {date} text/html {more}{len(content)}\n".encode() + content + b"\n"


def http_response(key: int | None, payload: bytes) -> bytes:
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n" % len(payload)
    return head + (b"" if key is None else b"%s: %d\r\n" % (_KEY, key)) + b"\r\n" + payload


def split_http(content: bytes) -> tuple[bytes, bytes, dict[bytes, bytes]]:
    """Head with its empty line, payload, fields. Content that is no HTTP response is all payload."""
    end = content.find(b"\r\n\r\n") + 4
    if not content.startswith(b"HTTP/") or end < 4:
        return b"", content, {}
    head = content[:end]
    fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:] if b": " in line)
    return head, content[end:], fields


def _key_of(fields: dict[bytes, bytes]) -> int | None:
    return int(fields[_KEY]) if _KEY in fields else None


def record_id(key: int, digest: str) -> str:
    """A version 8 UUID that holds the 64-bit key and 58 bits of the digest."""
    d = int.from_bytes(base64.b32decode(digest)[:8], "big") >> 6
    k = key & 0xFFFFFFFFFFFFFFFF
    n = (d >> 10) << 80 | 8 << 76 | (d & 1023) << 66 | (k >> 62) << 64 | 2 << 62 | k & ((1 << 62) - 1)
    return f"<urn:uuid:{uuid.UUID(int=n)}>"


def key_of_id(text: str) -> int:
    n = uuid.UUID(text.strip("<>")[9:]).int
    k = (n >> 64 & 3) << 62 | n & ((1 << 62) - 1)
    return k - (1 << 64) if k >> 63 else k


def _iso(date: str) -> str:
    """From the 14 digits (or fewer, in old files) of ARC."""
    d = (re.sub(r"\D", "", date) + "00000101000000"[len(date) :])[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def warc_record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def convert_record(header: dict, content: bytes, refers_to: int | None = None) -> bytes:
    """A WARC record for an ARC record: a response, or a revisit of the record with the given key."""
    head, payload, fields = split_http(content)
    digest, key = sha1_base32(payload), _key_of(fields)
    if key is None:
        key = int.from_bytes(hashlib.sha1(f"{header['url']} {header['date']}".encode()).digest()[:8], "big") >> 1
    block = content if refers_to is None else head
    kind = "response" if fields else "resource"
    out = [
        ("WARC-Type", kind if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(key, digest)),
        ("WARC-Date", _iso(header["date"])),
        ("WARC-Target-URI", header["url"]),
        ("WARC-IP-Address", header["ip"]),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"),
        ("Content-Type", "application/http; msgtype=response" if fields else header["type"]),
    ]
    if refers_to is not None:
        out[2:2] = [("WARC-Profile", _REVISIT), ("WARC-Refers-To", record_id(refers_to, digest))]
    return warc_record(out, block)


def parse_warc(file) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields in lower case, block) of each record."""
    stream = _Members(file)
    while (line := stream.line()) is not None:
        if not line:
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("a record begins with its version")
        fields = {}
        while line := stream.line():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.lower()] = value.strip()
        yield fields, stream.take(int(fields["content-length"]))


class _Out:
    """An archive of this task in the shared folder."""

    def __init__(self, folder: str, kind: str) -> None:
        self.name = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.{kind}.gz"
        system, path = fs.FileSystem.from_uri(folder)
        system.create_dir(path)
        self.path = f"{folder}/{self.name}"
        self.file = system.open_output_stream(f"{path}/{self.name}", compression=None)
        self.size = self.records = 0

    def add(self, data: bytes) -> None:
        m = _member(data)
        self.file.write(m)
        self.size += len(m)
        self.records += 1

    def done(self) -> pa.RecordBatch:
        self.file.close()
        return pa.RecordBatch.from_pydict({"path": [self.path], "records": pa.array([self.records], pa.int64())})


def _open(path: str):
    system, at = fs.FileSystem.from_uri(path)
    return system.open_input_file(at)


def write_arc(pages: DataFrame, folder: str, key_col: str, url_col: str, payload_col: str, date: str, most_bytes: int = 64 << 20) -> DataFrame:
    """Writes a record per row; (path, records) of the archives. Tasks with even numbers write version 1, others version 2."""
    rows = pages.select(F.col(key_col).cast("long").alias("key"), F.col(url_col).cast("string").alias("url"), F.col(payload_col).cast("binary").alias("payload"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, version = None, 1 + TaskContext.get().partitionId() % 2
        for batch in batches:
            for key, url, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    out = _Out(folder, "arc")
                    out.add(arc_version_block(version, out.name, date))
                url = quote(url or "about:blank", safe="!#$%&'()*+,/:;=?@[]~{}|^`\"<>\\")
                out.add(arc_record(version, url, date, http_response(key, payload or b""), out.name, out.size))
                if out.size >= most_bytes:
                    yield out.done()
                    out = None
        if out is not None:
            yield out.done()

    return stored(rows.mapInArrow(write, "path string, records long"), "arc_names")


def _spread(names: DataFrame) -> DataFrame:
    n = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return names.repartition(n, "path")


def index_arc(archives: DataFrame) -> DataFrame:
    """From (path), a row per record: path, offset, key, payload_bytes, digest."""
    names = ["path", "offset", "key", "payload_bytes", "digest"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path in (p for batch in batches for p in batch.column(0).to_pylist()):
            rows = []
            with _open(path) as file:
                for _, content, offset in parse_arc(file):
                    _, payload, fields = split_http(content)
                    rows.append((path, offset, _key_of(fields), len(payload), sha1_base32(payload)))
                    if len(rows) == 10_000:
                        yield _batch(rows, names, kinds)
                        rows = []
            yield _batch(rows, names, kinds)

    return stored(_spread(archives.select("path")).mapInArrow(index, "path string, offset long, key long, payload_bytes long, digest string"), "arc_index")


def _batch(rows: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def revisits(index: DataFrame, least: int = 0) -> DataFrame:
    """The index with `refers_to`: for all but the first of records with equal payloads, the key of the first."""
    place = F.struct("key", "path", "offset")
    able = F.col("key").isNotNull() & (F.col("payload_bytes") >= least)
    first = index.where(able).groupBy("digest", "payload_bytes").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    first = stored(first.where("n > 1").drop("n"), "firsts")
    told = index.where(able).join(first, ["digest", "payload_bytes"], "left")
    told = told.withColumn("refers_to", F.when(place != F.col("first"), F.col("first.key")))
    return told.select(*index.columns, "refers_to").unionByName(index.where(~able).withColumn("refers_to", F.lit(None).cast("long")))


def convert_arc(records: DataFrame, folder: str) -> DataFrame:
    """Writes a WARC record for each row (path, offset, refers_to); (path, records) of the archives."""
    n = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = records.select("path", "offset", "refers_to").repartitionByRange(n, "path", "offset").sortWithinPartitions("path", "offset")

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, source = None, None
        for batch in batches:
            for path, offset, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    out = _Out(folder, "warc")
                    about = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, out.name)}>"), ("WARC-Date", "2024-01-01T00:00:00Z"), ("WARC-Filename", out.name), ("Content-Type", "application/warc-fields")]
                    out.add(warc_record(about, b"format: WARC File Format 1.1\r\n"))
                if source is None or source.path != path:
                    source = _Places(path)
                out.add(convert_record(*source.at(offset), refers_to))
        if out is not None:
            yield out.done()

    return stored(rows.mapInArrow(convert, "path string, records long"), "warc_names")


class _Places:
    """The records of an ARC file at given offsets."""

    def __init__(self, path: str) -> None:
        self.path, self.file = path, _open(path)
        stream = _Members(self.file)
        block = stream.take(int(stream.line().rsplit(b" ", 1)[1]))
        self.names = _V2 if block.startswith(b"2") else _V1

    def at(self, offset: int) -> tuple[dict, bytes]:
        self.file.seek(offset)
        stream = _Members(_Chunks(self.file))
        header = dict(zip(self.names, stream.line().decode("utf-8", "replace").rsplit(" ", len(self.names) - 1), strict=True))
        return header, stream.take(int(header["length"]))


class _Chunks:
    """Reads a file in small steps, since a record is mostly small."""

    def __init__(self, file) -> None:
        self.file = file

    def read(self, _: int) -> bytes:
        return self.file.read(16_384)


def read_warc(archives: DataFrame) -> DataFrame:
    """From (path), a row per response or revisit: page_id, payload_bytes, payload_digest, record_type, refers_to, record_id, url."""
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "url"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path in (p for batch in batches for p in batch.column(0).to_pylist()):
            rows = []
            with _open(path) as file:
                for fields, block in parse_warc(file):
                    kind = fields["warc-type"]
                    if kind not in ("response", "revisit"):
                        continue
                    if sha1_base32(block) != fields["warc-block-digest"].removeprefix("sha1:"):
                        raise ValueError("a block does not have the digest that its record declares")
                    _, payload, http = split_http(block)
                    digest = fields["warc-payload-digest"].removeprefix("sha1:")
                    if kind == "response" and sha1_base32(payload) != digest:
                        raise ValueError("a payload does not have the digest that its record declares")
                    target = fields.get("warc-refers-to")
                    size = len(payload) if kind == "response" else int(http[b"Content-Length"])
                    rows.append((_key_of(http), size, digest, kind, None if target is None else key_of_id(target), fields["warc-record-id"], fields["warc-target-uri"]))
                    if len(rows) == 10_000:
                        yield _batch(rows, names, kinds)
                        rows = []
            yield _batch(rows, names, kinds)

    return _spread(archives.select("path")).mapInArrow(
        read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, url string"
    )


def archive_pages(
    pages: DataFrame, key_col: str = "page_id", url_col: str = "url", payload_col: str = "html", date: str = "20240101000000", least: int = 0
) -> DataFrame:
    """Pages to ARC archives, those to WARC archives, and what is read back from these, one row per page."""
    folder = workspace(pages.sparkSession)
    arcs = write_arc(pages, f"{folder}/arc", key_col, url_col, payload_col, date)
    warcs = convert_arc(revisits(index_arc(arcs), least), f"{folder}/warc")
    return read_warc(warcs)
