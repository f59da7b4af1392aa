"""WARC archives as a Spark data source (``format("warc")``).

Write: every row (record_id, target_uri, payload, refers_to) becomes a record in its own gzip
member: a ``response``, or a ``revisit`` without payload if it refers to another record.  Files
are rolled at ``roll_bytes``.  A member's header has its lengths (the ``sl`` extra field of the
WARC gzip annex), so that a reader can step over it without inflating it.  A task names its files
anew in each attempt; only the files of committed tasks get into the manifest that the commit writes,
so lost and repeated tasks leave nothing that is read.

Read: files are planned into partitions of about ``split_bytes``.  Predicates on ``record_type``,
``record_id``, ``target_uri``, ``refers_to`` and ``payload_digest`` are pushed down: a record's headers
are inflated first, and the rest of the member only if the record is wanted and the schema asks for
``payload`` or ``payload_sha1`` (what is computed from the bytes read).  Members without
lengths and plain ``.warc`` files are read too.

Pushdown needs ``spark.sql.python.filterPushdown.enabled``; ``register`` turns it on for the session.

Edge cases: a null payload is empty; a null record id or address leaves its header out and reads as
null; line breaks in header values become spaces; an empty table writes an empty archive, which reads
as no rows.  ``write_pages`` ignores columns that it doesn't know.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, IsNotNull,
                                    StringStartsWith, WriterCommitMessage)

from tideline.llm.common import materialise, shared_path
from tideline.sources.tables import read_table

ROLL_BYTES = 64 << 20
SPLIT_BYTES = 64 << 20
MANIFEST = "_manifest.json"
SCHEMA = ("record_id string, record_type string, target_uri string, date string, refers_to string, payload_digest string, "
          "payload_bytes long, payload binary, payload_sha1 string")
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HEADERS = {"WARC-Record-ID": "record_id", "WARC-Type": "record_type", "WARC-Target-URI": "target_uri", "WARC-Date": "date",
            "WARC-Refers-To": "refers_to", "WARC-Payload-Digest": "payload_digest"}


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


# ---- records -------------------------------------------------------------------------------------------------

def make_record(record_id: str | None, uri: str | None, payload: bytes, refers_to: str | None, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_id and f"<{record_id}>"), ("WARC-Target-URI", uri),
              ("WARC-Date", date), ("WARC-Payload-Digest", "sha1:" + sha1_base32(payload)), ("WARC-Refers-To", refers_to and f"<{refers_to}>"),
              ("WARC-Profile", _PROFILE if refers_to is not None else None), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "".join(f"{k}: {' '.join(v.splitlines())}\r\n" for k, v in fields if v is not None)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 6) -> bytes:
    """One gzip member with its compressed and plain length in an ``sl`` extra field."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    head = 10 + 2 + 4 + 8
    extra = b"sl" + struct.pack("<HII", 8, head + len(body) + 8, len(data))
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def _fields(head: bytes) -> dict[str, str]:
    out = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            out[name.strip().lower()] = value.strip()
    return out


class _Member:
    """A record's bytes, inflated no further than they are asked for."""

    def __init__(self, data: memoryview | bytes, at: int, packed: bool):
        self.data, self.at, self.packed = data, at, packed
        self.plain, self.end = b"", None
        if packed:
            self.inflate = zlib.decompressobj(31)
            self.rest = bytes(data[at:at + (1 << 16)])
            self.fed = at + len(self.rest)
            if data[at + 3] & 4 and bytes(data[at + 12:at + 14]) == b"sl":
                self.end = at + struct.unpack_from("<I", data, at + 16)[0]

    def upto(self, n: int | None) -> bytes:
        """At least n plain bytes (None: all), as far as there are."""
        if not self.packed:
            if n is None or len(self.plain) < n:
                self.plain = bytes(self.data[self.at:self.at + n]) if n is not None else bytes(self.data[self.at:])
            return self.plain
        parts = [self.plain]
        have = len(self.plain)
        while (n is None or have < n) and not self.inflate.eof:
            if not self.rest:
                self.rest = bytes(self.data[self.fed:self.fed + (1 << 16)])
                self.fed += len(self.rest)
                if not self.rest:
                    break
            parts.append(self.inflate.decompress(self.rest, 0 if n is None else n - have))
            self.rest = self.inflate.unconsumed_tail
            have += len(parts[-1])
        self.plain = b"".join(parts)
        return self.plain

    def until(self, mark: bytes, start: int = 0) -> int:
        """Place after the first ``mark`` from start, -1 if there is none."""
        n = start + 1024
        while (k := self.upto(n).find(mark, start)) < 0:
            if len(self.plain) < n:
                return -1
            n *= 2
        return k + len(mark)

    def finish(self, content_end: int) -> int:
        """Where the next record begins."""
        if not self.packed:
            return self.at + content_end + 4
        if self.end is None:
            self.upto(None)
            self.end = self.fed - len(self.inflate.unused_data)
        return self.end


def read_records(data: bytes, wanted, columns: list[str]) -> Iterator[dict]:
    """The wanted records of a file.  wanted: row of headers -> bool."""
    at, deep = 0, {"payload", "payload_sha1"} & set(columns)
    while at < len(data):
        member = _Member(data, at, bytes(data[at:at + 2]) == b"\x1f\x8b")
        head = member.until(b"\r\n\r\n")
        if head < 0:
            break
        fields = _fields(member.plain[:head])
        row = {name: fields.get(header.lower()) for header, name in _HEADERS.items()}
        for name in ("record_id", "refers_to"):
            row[name] = row[name] and row[name].strip("<>")
        row["payload_digest"] = row["payload_digest"] and row["payload_digest"].removeprefix("sha1:")
        length = int(fields.get("content-length", 0))
        if wanted(row):
            begin, row["payload_bytes"] = head, length
            if fields.get("content-type", "").startswith("application/http"):
                begin = member.until(b"\r\n\r\n", head)
                begin = head + length if begin < 0 else begin
                said = _fields(member.plain[head:begin]).get("content-length")
                row["payload_bytes"] = int(said) if said else head + length - begin
            if deep and row["record_type"] != "revisit":
                payload = member.upto(head + length)[begin:head + length]
                row["payload"], row["payload_bytes"] = payload, len(payload)
                if "payload_sha1" in deep:
                    row["payload_sha1"] = sha1_base32(payload)
            yield row
        at = member.finish(head + length)


# ---- data source ---------------------------------------------------------------------------------------------

@dataclass
class Files(InputPartition):
    paths: list[str]


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, int]]


class WarcReader(DataSourceReader):
    def __init__(self, path: str, columns: list[str], split_bytes: int):
        self.path, self.columns, self.split_bytes, self.tests = path, columns, split_bytes, []

    def pushFilters(self, filters):
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name not in _HEADERS.values() or not isinstance(f, (EqualTo, In, IsNotNull, StringStartsWith)):
                yield f
            else:
                self.tests.append((name, type(f).__name__, getattr(f, "value", None)))

    def partitions(self):
        fs, root = _open(self.path)
        manifest = f"{root}/{MANIFEST}"
        if fs.get_file_info(manifest).type == pafs.FileType.File:
            with fs.open_input_stream(manifest) as f:
                files = [(f"{root}/{name}", size) for name, size in json.loads(f.read())]
        else:
            found = [fs.get_file_info(root)] if fs.get_file_info(root).type == pafs.FileType.File else fs.get_file_info(pafs.FileSelector(root, recursive=True))
            files = [(i.path, i.size) for i in found if i.type == pafs.FileType.File and i.path.endswith((".warc", ".warc.gz"))]
        parts, room = [], 0
        for path, size in sorted(files):
            if not parts or size > room:
                parts.append(Files([]))
                room = self.split_bytes
            parts[-1].paths.append(path)
            room -= size
        return parts or [Files([])]

    def _wanted(self, row: dict) -> bool:
        for name, kind, value in self.tests:
            x = row[name]
            if x is None or kind == "EqualTo" and x != value or kind == "In" and x not in value or kind == "StringStartsWith" and not x.startswith(value):
                return False
        return True

    def read(self, partition):
        fs, kinds = _open(self.path)[0], {"payload_bytes": pa.int64(), "payload": pa.binary()}
        schema = pa.schema([(c, kinds.get(c, pa.string())) for c in self.columns])
        rows, size = [], 0
        for path in partition.paths:
            with fs.open_input_file(path) as f:
                data = memoryview(f.read())
            for row in read_records(data, self._wanted, self.columns):
                rows.append([row.get(c) for c in self.columns])
                size += 500 + len(row.get("payload") or b"")
                if size > 4 << 20:
                    yield self._batch(rows, schema)
                    rows, size = [], 0
        if rows:
            yield self._batch(rows, schema)

    @staticmethod
    def _batch(rows, schema):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, date: str, roll_bytes: int):
        self.path, self.date, self.roll_bytes = path, date, roll_bytes

    def write(self, iterator):
        fs, root = _open(self.path)
        fs.create_dir(root, recursive=True)
        files, out, size = [], None, 0
        for batch in iterator:
            for i in range(batch.num_rows):
                record_id, uri, payload, refers_to = (batch.column(c)[i].as_py() for c in ("record_id", "target_uri", "payload", "refers_to"))
                member = gzip_member(make_record(record_id, uri, payload or b"", refers_to, self.date))
                if out is None:
                    files.append((f"{uuid.uuid4().hex}.warc.gz", 0))
                    out, size = fs.open_output_stream(f"{root}/{files[-1][0]}", compression=None), 0
                out.write(member)
                size += len(member)
                if size >= self.roll_bytes:
                    out.close()
                    files[-1], out = (files[-1][0], size), None
        if out is not None:
            out.close()
            files[-1] = (files[-1][0], size)
        return Written(files)

    def commit(self, messages):
        fs, root = _open(self.path)
        fs.create_dir(root, recursive=True)
        with fs.open_output_stream(f"{root}/{MANIFEST}", compression=None) as f:
            f.write(json.dumps(sorted(x for m in messages if m for x in m.files)).encode())

    def abort(self, messages):
        fs, root = _open(self.path)
        for m in messages:
            for name, _ in m.files if m else ():
                fs.delete_file(f"{root}/{name}")


class WarcDataSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options["path"], schema.fieldNames(), int(self.options.get("split_bytes", SPLIT_BYTES)))

    def writer(self, schema, overwrite):
        return WarcWriter(self.options["path"], self.options.get("date", "1970-01-01T00:00:00Z"), int(self.options.get("roll_bytes", ROLL_BYTES)))


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


# ---- pages ---------------------------------------------------------------------------------------------------

def write_pages(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0) -> None:
    """A record per row.  Of pages with equal payloads of at least ``min_bytes`` the one with the largest id is
    the response and the others revisit it; rows that repeat that id are all responses, null ids come last.

    Only payloads that occur twice are joined, by digest; that table is written first, so its real size decides
    whether it is broadcast.  A digest of many pages is one row of a task before the shuffle."""
    register(pages.sparkSession)
    raw = F.coalesce(F.col(html).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(page_id).cast("string").alias("id"), F.col(page_id).alias("order"), F.col(url).alias("target_uri"), raw.alias("payload"))
    rows = rows.withColumn("digest", F.when(F.length("payload") >= min_bytes, F.sha1("payload")))
    twice = materialise(rows.filter("digest IS NOT NULL").groupBy("digest").agg(F.max("order").alias("last"), F.count("*").alias("n"))
                        .filter("n > 1 AND last IS NOT NULL").select(F.col("digest").alias("d"), "last"), "repeated-payloads")
    joined = rows.join(twice, F.col("digest") == F.col("d"), "left")
    revisit = F.col("last").isNotNull() & ~F.col("order").eqNullSafe(F.col("last"))
    (joined.select(F.concat(F.lit("urn:page:"), "id").alias("record_id"), "target_uri", "payload",
                   F.when(revisit, F.concat(F.lit("urn:page:"), F.col("last").cast("string"))).alias("refers_to"))
     .write.format("warc").mode("append").save(path))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, written to archives in the shared folder and read back: payloads of responses, headers of revisits."""
    path = shared_path(spark, "warc")
    write_pages(read_table(spark, sf_dir, "pages"), path)
    head = "record_id string, record_type string, refers_to string, payload_digest string, payload_bytes long"
    responses = spark.read.format("warc").schema(head + ", payload_sha1 string").load(path).filter("record_type = 'response'")
    revisits = spark.read.format("warc").schema(head).load(path).filter("record_type = 'revisit'")
    number = {c: F.expr(f"cast(substring({c}, {len('urn:page:') + 1}) as bigint)") for c in ("record_id", "refers_to")}
    out = responses.drop("payload_digest").withColumnRenamed("payload_sha1", "payload_digest").unionByName(revisits)
    return out.select(number["record_id"].alias("page_id"), "payload_bytes", "payload_digest", "record_type", number["refers_to"].alias("refers_to"))
