"""WARC archives, written and read by a Python data source.

Writing.  A page becomes one record: an HTTP response, or, when an equal
payload stands under a smaller id, a revisit that refers to it and holds the
HTTP head only.  Records are whole strings made by Spark.  Each task writes
one archive, a gzip member for each record; the member's header tells its
length, and beside the archive stands a list of the places where it may be
split.  Archives are written aside and moved into place when all tasks have
ended, so tasks may be run again.

Reading.  ``spark.read.format("warc")`` plans partitions of about
``SPLIT_BYTES`` of an archive (archives of other makers, without that list,
are one partition each).  Filters on record_type and on other header columns
(equality and IN) are pushed down (``read_archives`` turns on
spark.sql.python.filterPushdown.enabled) and can also be given as options
named after the column; the header of a record is parsed first, and of a
record that is not wanted nothing beyond it is inflated or read: the reader
goes on at the next member.  With option ``payload`` false no payload is kept
and only digests are made.

Defined results: a null payload is empty; a null id is written as such and is
never the smallest; rows with equal payloads that repeat the smallest id are
all responses; payloads under ``min_bytes`` are all responses; an empty
table gives no archives and no records.  Other columns are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition,
                                    WriterCommitMessage)

CRLF = "\r\n"
END = "\r\n\r\n"
SCHEMA = ("record_id string, record_type string, target_uri string, refers_to_id string, payload_bytes bigint, "
          "payload_digest string, payload binary")
HEADERS = {"record_id": "warc-record-id", "record_type": "warc-type", "target_uri": "warc-target-uri",
           "refers_to_id": "warc-refers-to"}


def record_id(key) -> "F.Column":
    return F.concat(F.lit("urn:x-page:"), F.coalesce(key.cast("string"), F.lit("null")))


def write_archives(pages: DataFrame, path: str, key: str = "page_id", payload: str = "html", uri: str = "url",
                   min_bytes: int = 0, compression: str = "gzip") -> None:
    """Write ``pages`` as WARC files under the folder ``path``."""
    body = F.coalesce(F.col(payload), F.lit(""))
    rows = pages.select(F.col(key).alias("k"), F.col(uri).alias("uri"), body.alias("body"))
    rows = rows.withColumns({"sha": F.sha1(F.col("body").cast("binary")), "size": F.octet_length("body")})
    copies = rows.where(F.col("size") >= min_bytes).groupBy("sha", "size").agg(F.min("k").alias("first"), F.count(F.lit(1)).alias("n")) \
        .where("n > 1 and first is not null")
    copies = copies.select(F.col("sha").alias("s2"), F.col("size").alias("z2"), F.xxhash64("sha").alias("x2"), "first")
    # Only repeated payloads are joined; the third key lets AQE split a hot one.
    rows = rows.join(copies, (F.col("sha") == F.col("s2")) & (F.col("size") == F.col("z2")) & (F.xxhash64("sha") == F.col("x2")), "left")
    revisit = F.col("first").isNotNull() & ~F.col("k").eqNullSafe(F.col("first"))
    digest = F.concat(F.lit("sha1:"), _base32(F.col("sha")))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("size").cast("string"), F.lit(END))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("body")))
    length = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("size"))

    def line(name: str, value) -> "F.Column":
        return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))

    clean_uri = F.regexp_replace(F.col("uri"), r"[\r\n]", "")
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}"), F.when(revisit, line("WARC-Type", F.lit("revisit"))).otherwise(line("WARC-Type", F.lit("response"))),
        line("WARC-Record-ID", F.concat(F.lit("<"), record_id(F.col("k")), F.lit(">"))),
        F.coalesce(line("WARC-Target-URI", clean_uri), F.lit("")), line("WARC-Payload-Digest", digest),
        F.when(revisit, F.concat(line("WARC-Refers-To", F.concat(F.lit("<"), record_id(F.col("first")), F.lit(">"))), line(
            "WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")))).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")), line("Content-Length", length.cast("string")), F.lit(CRLF))
    records = rows.select(F.concat(head, block, F.lit(END)).alias("value"))
    pages.sparkSession.dataSource.register(WarcSource)
    records.write.format("warc").option("compression", compression).mode("append").save(path)


def _base32(hexed) -> "F.Column":
    """Base32 of a 20-byte digest in hex: 160 bits are 32 letters of 5 bits;
    five hex digits (20 bits) give four letters."""
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    parts = []
    for i in range(8):
        value = F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 10).cast("int")
        parts += [letters.substr(F.shiftright(value, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*parts)


SPLIT_BYTES = 64 << 20
# A gzip header with one extra field, "SL": the lengths of the whole member
# and of what it holds.
MEMBER = "<4sIBBH2sHQQ"
MEMBER_SIZE = struct.calcsize(MEMBER)
MAGIC = b"\x1f\x8b\x08\x04"


def _member(data: bytes) -> bytes:
    """A record as a gzip member that tells its length."""
    deflate = zlib.compressobj(6, zlib.DEFLATED, -zlib.MAX_WBITS)
    body = deflate.compress(data) + deflate.flush()
    head = struct.pack(MEMBER, MAGIC, 0, 0, 255, 20, b"SL", 16, MEMBER_SIZE + len(body) + 8, len(data))
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


class Member(io.RawIOBase):
    """What a gzip member holds, inflated as it is read."""

    def __init__(self, stream, length: int, held: int) -> None:
        self.stream, self.left = stream, length - MEMBER_SIZE
        self.inflate, self.held, self.crc, self.pending = zlib.decompressobj(-zlib.MAX_WBITS), held, 0, b""

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while not self.inflate.eof:
            if not self.pending:
                self.pending = self.stream.read(min(self.left, 1 << 14))
                self.left -= len(self.pending)
                if not self.pending:
                    raise ValueError("a WARC member is cut short")
            data = self.inflate.decompress(self.pending, len(buffer))
            self.pending = self.inflate.unconsumed_tail
            if data:
                buffer[:len(data)] = data
                self.crc, self.held = zlib.crc32(data, self.crc), self.held - len(data)
                return len(data)
        end = self.inflate.unused_data
        end += self.stream.read(8 - len(end)) if len(end) < 8 else b""
        if self.held or struct.unpack("<I", end[:4])[0] != self.crc:
            raise ValueError("a WARC member is damaged")
        return 0


@dataclass
class Written(WriterCommitMessage):
    name: str
    splits: list[int]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict) -> None:
        self.path, self.plain = options["path"], options.get("compression", "gzip") == "none"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        system, root = _file_system(self.path)
        name = f"part-{uuid.uuid4().hex}.warc" + ("" if self.plain else ".gz")
        system.create_dir(f"{root}/_pending", recursive=True)
        at, splits, out = 0, [0], None
        for batch in iterator:
            for value in batch.column(0):
                out = out or system.open_output_stream(f"{root}/_pending/{name}", compression=None)
                data = value.as_py().encode("utf-8")
                data = data if self.plain else _member(data)
                if at - splits[-1] >= SPLIT_BYTES:
                    splits.append(at)
                out.write(data)
                at += len(data)
        if out is None:
            return Written("", [])
        out.close()
        return Written(name, [*splits, at])

    def commit(self, messages: list) -> None:
        system, root = _file_system(self.path)
        for m in messages:
            if m is not None and m.name:
                with system.open_output_stream(f"{root}/_{m.name}.splits", compression=None) as out:
                    out.write("\n".join(map(str, m.splits)).encode())
                system.move(f"{root}/_pending/{m.name}", f"{root}/{m.name}")
        self.abort(messages)

    def abort(self, messages: list) -> None:
        from pyarrow import fs

        system, root = _file_system(self.path)
        if system.get_file_info(f"{root}/_pending").type == fs.FileType.Directory:
            system.delete_dir(f"{root}/_pending")


class WarcPart(InputPartition):
    """Records of a file from one place to another (none: all of it, by
    other makers)."""

    def __init__(self, path: str, start: int | None = None, end: int | None = None) -> None:
        self.path, self.start, self.end = path, start, end


def _file_system(path: str):
    """(file system, path in it) for a URI or a local path."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


class WarcReader(DataSourceReader):
    BATCH_BYTES, BATCH_ROWS = 1 << 24, 10_000

    def __init__(self, options: dict) -> None:
        self.path = options["path"]
        self.payload = str(options.get("payload", "true")).lower() == "true"
        self.wanted = {c: {options[c]} for c in HEADERS if c in options}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            values = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
            if column in HEADERS and values is not None:
                self.wanted[column] = values & self.wanted.get(column, values)
            else:
                yield f  # Spark applies the rest

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        system, root = _file_system(self.path)
        found = system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
        infos = {i.path: i for i in found if i.type == fs.FileType.File}
        prefix = self.path[: len(self.path) - len(root)] if self.path.endswith(root) and not self.path.startswith("/") else ""
        parts: list[InputPartition] = []
        for name, info in sorted(infos.items()):
            if not info.size or any(p.startswith(("_", ".")) for p in name[len(root):].split("/")):
                continue
            beside = f"{name[:-len(info.base_name)]}_{info.base_name}.splits"
            if beside in infos:
                with system.open_input_stream(beside, compression=None) as stream:
                    places = [int(x) for x in stream.read().split()]
                parts += [WarcPart(prefix + name, a, b) for a, b in zip(places, places[1:])]
            else:
                parts.append(WarcPart(prefix + name))
        return parts or [WarcPart("")]

    def read(self, partition: WarcPart) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()), ("refers_to_id", pa.string()),
                            ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])
        rows: list[tuple] = []
        held = 0
        for row in self.rows(partition) if partition.path else ():
            rows.append(row)
            held += len(row[6] or b"") + 200
            if held >= self.BATCH_BYTES or len(rows) >= self.BATCH_ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    def rows(self, part: WarcPart) -> Iterator[tuple]:
        system, name = _file_system(part.path)
        if part.start is None:
            with system.open_input_stream(name, compression=None) as raw:
                stream = io.BufferedReader(raw, 1 << 20)
                stream = gzip.GzipFile(fileobj=stream) if name.endswith(".gz") else stream
                more = True
                while more:
                    row, more = self.record(stream, _skip)
                    if row:
                        yield row
            return
        with system.open_input_file(name) as raw:
            stream = io.BufferedReader(raw, 1 << 18)
            at = part.start
            while at < part.end:
                stream.seek(at)  # what was left of the record before is not read
                if name.endswith(".gz"):
                    magic, *_, tag, _, length, size = struct.unpack(MEMBER, _exactly(stream, MEMBER_SIZE))
                    if magic != MAGIC or tag != b"SL":
                        raise ValueError("a WARC member was expected")
                    row, _ = self.record(io.BufferedReader(Member(stream, length, size)), None)
                    at += length
                else:
                    row, more = self.record(stream, lambda s, n: s.seek(n, 1))
                    at = stream.tell() + len(END) if more else part.end
                if row:
                    yield row

    def record(self, stream, skip: Callable | None) -> tuple[tuple | None, bool]:
        """(the next record's row, or None for one that is not wanted; whether
        there was a record).  ``skip`` passes over a block; None leaves it."""
        line = stream.readline()
        while line and not line.strip():
            line = stream.readline()  # blank lines end the record before
        if not line:
            return None, False
        if not line.startswith(b"WARC/"):
            raise ValueError("a WARC record was expected")
        head = _header_lines(stream)
        length = int(head["content-length"])
        found = {c: _bare(head.get(name)) for c, name in HEADERS.items()}
        if any(found[c] not in values for c, values in self.wanted.items()):
            if skip:
                skip(stream, length)
            return None, True
        block = io.BytesIO(_exactly(stream, length))
        if skip is None:
            stream.read()  # to the end of the member, which checks it
        declared = None
        if head.get("content-type", "").startswith("application/http"):
            block.readline()
            declared = _header_lines(block).get("content-length")
        payload = block.read()
        if found["record_type"] == "revisit":  # the payload stands elsewhere
            size = int(declared) if declared is not None else None
            digest = head.get("warc-payload-digest", "").removeprefix("sha1:") or None
            payload = None
        else:
            size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
        row = (*[found[c] for c in ("record_id", "record_type", "target_uri", "refers_to_id")], size, digest, payload if self.payload else None)
        return row, True


def _header_lines(stream) -> dict[str, str]:
    out = {}
    for line in iter(stream.readline, b""):
        if not line.strip():
            break
        name, _, value = line.decode("utf-8", "replace").partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def _bare(value: str | None) -> str | None:
    return value[1:-1] if value and value.startswith("<") and value.endswith(">") else value


def _exactly(stream, n: int) -> bytes:
    data = stream.read(n)
    if len(data) != n:
        raise ValueError("a WARC record is cut short")
    return data


def _skip(stream, n: int) -> None:
    while n:
        got = len(stream.read(min(n, 1 << 20)))
        if not got:
            raise ValueError("a WARC record is cut short")
        n -= got


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options)


def read_archives(spark: SparkSession, path: str, **options: str) -> DataFrame:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")  # Spark refuses the reader without it
    reader = spark.read.format("warc")
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader.load(path)
