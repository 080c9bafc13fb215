"""WARC archives as a Spark data source, and de-duplicated writing of pages.

Writing: every task streams records into files of its own; the names that tasks
report on success, with the offsets of splits, go into one manifest, so files of
failed or repeated attempts are never read. Reading plans partitions from the
manifest (or from a plain listing, one partition a file), parses a record's headers
first and applies the pushed-down predicates to them: the payload of a record that
fails, or whose payload nobody asked for, is skipped over and never read, in
compressed files too: written records are two gzip members each, headers and the rest.

Paths are local, or any URI that pyarrow opens (file, hdfs, s3, gs).
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import re
import struct
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    Not,
    StringContains,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)

SCHEMA = (
    "record_id string, record_type string, target_uri string, date string, refers_to string, "
    "payload_digest string, payload_bytes long, payload binary"
)
HEADER_FIELDS = {
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
}
#: Fixed value: the profile of a revisit by equal payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Effort of gzip.
LEVEL = 4
SPLIT_BYTES = 16 << 20
FILE_BYTES = 1 << 30
_BATCH = 256
_MANIFEST = "_manifest.json"


def opened(path: str):
    """File system and path of a URI or an absolute path."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", path))


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


@dataclass
class Split(InputPartition):
    file: str
    start: int
    end: int | None


@dataclass
class Written(WriterCommitMessage):
    files: list


_FRAME = struct.Struct("<2sHQQ")
_MARK = b"wr"


def _member(data: bytes, extra: bytes = b"") -> bytes:
    """A gzip member, with an extra field if there is one."""
    deflate = zlib.compressobj(LEVEL, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    head = b"\x1f\x8b\x08" + (b"\x04" if extra else b"\0") + b"\0\0\0\0\0\xff"
    tail = struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    return head + (struct.pack("<H", len(extra)) + extra if extra else b"") + body + tail


def framed(head: bytes, rest: bytes) -> bytes:
    """A record as two gzip members, headers and the rest. The first one's extra field
    tells the lengths of both, so that a reader can leave the rest alone; other readers
    see one plain gzip stream."""
    second = _member(rest)
    first = len(_member(head, bytes(_FRAME.size)))
    return _member(head, _FRAME.pack(_MARK, _FRAME.size - 4, first, len(second))) + second


class Frames:
    """A file of framed records as a stream of bytes. Skipping what is left of a record
    skips its second member without reading it."""

    def __init__(self, file):
        self.file, self.at, self.rest, self.now = file, file.tell(), 0, io.BytesIO()

    @staticmethod
    def fits(file) -> bool:
        """Whether the file goes on with a framed record; leaves its position alone."""
        start, head = file.tell(), file.read(12 + _FRAME.size)
        file.seek(start)
        return len(head) == 12 + _FRAME.size and head[3] == 4 and head[12:14] == _MARK

    def tell(self) -> int:
        """Where the next record begins."""
        return self.at

    def _next(self) -> bool:
        if self.rest:
            self.now, self.rest = io.BytesIO(zlib.decompress(self.file.read(self.rest), 31)), 0
            return True
        head = self.file.read(12 + _FRAME.size)
        if not head:
            return False
        _, _, first, second = _FRAME.unpack_from(head, 12)
        self.now = io.BytesIO(zlib.decompress(head + self.file.read(first - len(head)), 31))
        self.rest, self.at = second, self.at + first + second
        return True

    def readline(self, most: int = -1) -> bytes:
        line = self.now.readline(most)
        return line if line or not self._next() else self.now.readline(most)

    def read(self, n: int) -> bytes:
        data = self.now.read(n)
        while len(data) < n and self._next():
            data += self.now.read(n - len(data))
        return data

    def seek(self, n: int, whence: int) -> None:
        left = self.now.getbuffer().nbytes - self.now.tell()
        if n > left and self.rest:
            self.file.seek(self.at)
            self.rest, self.now = 0, io.BytesIO()
        else:
            self.now.seek(n, whence)


def _header_test(f: Filter):
    """A test on parsed headers for a predicate that headers decide, else None."""
    if isinstance(f, Not):
        inner = _header_test(f.child)
        # Null fields satisfy neither a predicate nor its opposite.
        return inner and (lambda h: inner(h) is False)
    column = getattr(f, "attribute", ("",))
    if len(column) != 1 or column[0] not in HEADER_FIELDS:
        return None
    name, value = column[0], getattr(f, "value", None)

    def over(test):
        return lambda h: None if h[name] is None else test(h[name])

    tests = {
        EqualTo: over(lambda x: x == value),
        EqualNullSafe: lambda h: h[name] == value,
        GreaterThan: over(lambda x: x > value),
        GreaterThanOrEqual: over(lambda x: x >= value),
        LessThan: over(lambda x: x < value),
        LessThanOrEqual: over(lambda x: x <= value),
        In: over(lambda x: x in f.value),
        IsNull: lambda h: h[name] is None,
        IsNotNull: lambda h: h[name] is not None,
        StringStartsWith: over(lambda x: x.startswith(value)),
        StringEndsWith: over(lambda x: x.endswith(value)),
        StringContains: over(lambda x: value in x),
    }
    return tests.get(type(f))


def records(stream, end: int | None, wanted, payloads: bool) -> Iterator[tuple]:
    """Rows of the records that begin before ``end``. Foreign records without an HTTP
    head have their whole block as payload."""
    while end is None or stream.tell() < end:
        line = stream.readline()
        while line in (b"\r\n", b"\n"):
            line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record at byte {stream.tell() - len(line)}")
        head = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            key, _, value = line.decode("utf-8", "replace").partition(":")
            head[key.strip().lower()] = value.strip()
        row = {c: head.get(h.lower()) for c, h in HEADER_FIELDS.items()}
        for c in ("record_id", "refers_to"):
            row[c] = row[c] and row[c].removeprefix("<").removesuffix(">")
        row["payload_digest"] = row["payload_digest"] and row["payload_digest"].removeprefix("sha1:")
        left = int(head["content-length"])
        if not all(test(row) for test in wanted):
            stream.seek(left, io.SEEK_CUR)
            continue
        full, http = None, {}
        if head.get("content-type", "").startswith("application/http"):
            while left > 0:
                line = stream.readline(left)
                left -= len(line)
                if line in (b"\r\n", b"\n", b""):
                    break
                key, _, value = line.decode("latin-1").partition(":")
                http[key.strip().lower()] = value.strip()
        full = int(http.get("content-length", left))
        payload = None
        if row["record_type"] == "revisit" or not payloads:
            stream.seek(left, io.SEEK_CUR)
        else:
            payload = stream.read(left)
            if len(payload) != left:
                raise ValueError(f"record {row['record_id']} is cut short")
            if row["payload_digest"] not in (None, base32(hashlib.sha1(payload).digest())):
                raise ValueError(f"record {row['record_id']} does not match its digest")
            full = len(payload)
        yield (*row.values(), full, payload)


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.payloads = options.get("payload", "true").lower() == "true"
        self.filters: list[Filter] = []

    def pushFilters(self, filters):
        for f in filters:
            if _header_test(f) is not None:
                self.filters.append(f)
            else:
                yield f

    def partitions(self):
        fs, root = opened(self.path)
        manifest = f"{root}/{_MANIFEST}"
        if fs.get_file_info(manifest).type == pafs.FileType.File:
            with fs.open_input_stream(manifest) as file:
                listed = json.loads(file.read())
            found = []
            for name, size, starts in listed:
                ends = [*starts[1:], size]
                found += [Split(f"{self.path}/{name}", s, e) for s, e in zip(starts, ends, strict=True)]
            return found
        if fs.get_file_info(root).type == pafs.FileType.File:
            return [Split(self.path, 0, None)]
        inside = fs.get_file_info(pafs.FileSelector(root, recursive=True))
        names = sorted(i.path for i in inside if i.path.endswith((".warc", ".warc.gz")))
        return [Split(self.path + n.removeprefix(root), 0, None) for n in names]

    def read(self, split):
        if split is None:  # a table without partitions
            return
        fs, path = opened(split.file)
        wanted = [_header_test(f) for f in self.filters]
        types = [pa.string()] * len(HEADER_FIELDS) + [pa.int64(), pa.binary()]
        names = [*HEADER_FIELDS, "payload_bytes", "payload"]

        def batch(rows):
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            return pa.RecordBatch.from_arrays(columns, names)

        with fs.open_input_file(path) as file:
            stream = io.BufferedReader(file, 1 << 20)
            stream.seek(split.start)
            if path.endswith(".gz"):
                stream = Frames(stream) if Frames.fits(stream) else gzip.GzipFile(fileobj=stream)
            rows = []
            for row in records(stream, split.end, wanted, self.payloads):
                rows.append(row)
                if len(rows) == _BATCH:
                    yield batch(rows)
                    rows = []
            if rows:
                yield batch(rows)


def _line(name: str, value: str) -> str:
    return f"{name}: {value}\r\n"


def record(row: dict) -> tuple[bytes, bytes]:
    """Headers and the rest of one record; a revisit keeps the HTTP head of the full payload."""
    payload = row["payload"] if row["record_type"] != "revisit" else b""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {row['payload_bytes']}\r\n\r\n"
    ).encode()
    head = "WARC/1.1\r\n" + _line("WARC-Type", row["record_type"])
    head += _line("WARC-Record-ID", f"<{row['record_id']}>") + _line("WARC-Date", row["date"])
    if row["target_uri"] is not None:
        safe = urllib.parse.quote(row["target_uri"].encode(), safe="%/:=&?~#+!$,;'@()*[]")
        head += _line("WARC-Target-URI", safe)
    if row["record_type"] == "revisit":
        head += _line("WARC-Profile", PROFILE) + _line("WARC-Refers-To", f"<{row['refers_to']}>")
    head += _line("WARC-Payload-Digest", "sha1:" + row["payload_digest"])
    head += _line("Content-Type", "application/http; msgtype=response")
    head += _line("Content-Length", str(len(http) + len(payload)))
    return head.encode() + b"\r\n" + http, payload + b"\r\n\r\n"


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options):
        self.path = options["path"]
        self.gzip = options.get("compression", "gzip") == "gzip"

    def write(self, iterator):
        fs, root = opened(self.path)
        fs.create_dir(root, recursive=True)
        files, out, at, starts, name = [], None, 0, [], ""
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    if out is not None and at >= FILE_BYTES:
                        out.close()
                        files.append((name, at, starts))
                        out = None
                    if out is None:
                        name = f"part-{uuid.uuid4().hex}.warc" + ".gz" * self.gzip
                        out, at, starts = fs.open_output_stream(f"{root}/{name}", compression=None), 0, [0]
                    if at - starts[-1] >= SPLIT_BYTES:
                        starts.append(at)
                    data = framed(*record(row)) if self.gzip else b"".join(record(row))
                    out.write(data)
                    at += len(data)
        finally:
            if out is not None:
                out.close()
        if out is not None:
            files.append((name, at, starts))
        return Written(files)

    def commit(self, messages):
        fs, root = opened(self.path)
        fs.create_dir(root, recursive=True)
        listed = [f for m in messages if m is not None for f in m.files]
        with fs.open_output_stream(f"{root}/{_MANIFEST}") as file:
            file.write(json.dumps(listed).encode())

    def abort(self, messages):
        """Nothing to undo: files that no manifest names are never read."""


class WarcSource(DataSource):
    """``format("warc")``; read option ``payload=false`` reads headers only, write option
    ``compression`` is ``gzip`` or ``none``."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options)


def _registered(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Records of the archives below ``path``. Payloads are checked against their
    digests. Filters on record type and the other header fields are pushed down."""
    reader = _registered(spark).read.format("warc").option("payload", str(payload).lower())
    return reader.load(path)


def write_warc(df: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write records with the columns of ``SCHEMA`` (digest as base32)."""
    _registered(df.sparkSession)
    writer = df.select(*[c.split()[0] for c in SCHEMA.split(", ")]).write.format("warc")
    writer.mode("append").option("compression", compression).save(path)


def page_records(
    pages: DataFrame, least: int = 0, date: str = "2024-01-01T00:00:00Z", key="page_id", url="url", html="html"
) -> DataFrame:
    """Records of pages: among equal payloads of at least ``least`` bytes the smallest
    key is the response and the others revisit it; smaller ones are all responses.

    Null payloads count as empty; null keys are largest and get an id of no key; rows
    with the same smallest key and payload are all responses. Only payloads that occur
    again are joined, and a payload with very many copies is a skewed join partition,
    which the adaptive rule splits. An empty table gives no records.
    """
    body = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(key).alias("key"), F.col(url).alias("target_uri"), body.alias("payload"), F.sha1(body).alias("sha1")
    ).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    copies = rows.groupBy("sha1", "payload_bytes").agg(F.min("key").alias("first"), F.count("*").alias("n"))
    copies = copies.where((F.col("n") > 1) & (F.col("payload_bytes") >= least)).drop("n")
    rows = rows.join(copies, ["sha1", "payload_bytes"], "left")
    again = F.col("first").isNotNull() & ~F.col("key").eqNullSafe(F.col("first"))

    def name(c):
        return F.concat(F.lit("urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")))

    return rows.select(
        name("key").alias("record_id"),
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        "target_uri",
        F.lit(date).alias("date"),
        F.when(again, name("first")).alias("refers_to"),
        digest32(F.col("sha1")).alias("payload_digest"),
        "payload_bytes",
        F.when(~again, F.col("payload")).alias("payload"),
    )


#: Fixed alphabet of base32.
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def digest32(hexes):
    """Base32 of a 40-digit hex digest: five hex digits are four base32 digits."""
    bits = [F.conv(F.substring(hexes, 5 * g + 1, 5), 16, 10).cast("int") for g in range(8)]
    digits = [
        F.substring(F.lit(_BASE32), F.shiftright(b, s).bitwiseAND(31) + 1, F.lit(1)) for b in bits for s in (15, 10, 5, 0)
    ]
    return F.concat(*digits)


def page_key(name):
    """The key inside a record id of ``page_records``; null where there was none."""
    return F.expr(f"try_cast(substring({name}, {len('urn:page:') + 1}) AS BIGINT)")
