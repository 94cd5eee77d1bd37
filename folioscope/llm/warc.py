"""WARC as a PySpark Python data source (operator 6): writer, reader, revisit records.

Reading: one input partition per archive file (the writer rolls files at
`max_file_bytes`, so a partition is bounded). Filters on record_type,
target_uri, record_id, refers_to and payload_digest are pushed down: a record's
headers are parsed first, and if they fail a predicate, or if payloads aren't
asked for (option payload=false), the block is skipped. In a plain archive it is skipped by its
Content-Length. In a .gz archive every record is a gzip member of its own, of which only so much
is inflated as the headers need; the writer puts the member's size in the skip-lengths
("sl") extra field of its gzip header, by which the reader jumps to the next one. Members of
other writers without that field have to be inflated to be skipped, in small pieces that aren't kept.

Records are WARC/1.1: every one has WARC-Record-ID, WARC-Date, WARC-Type and Content-Length;
identifiers stand in angle brackets, digests after "sha1:", revisits carry WARC-Profile, and blocks of type
application/http begin with the HTTP head, which the reader splits off. Columns hold bare identifiers
and digests, `headers` all headers as they are.

Writing: each task writes files under a name of its own; commit() publishes
their names in `_manifest`, and the reader reads what the manifest lists, so
files of failed, repeated or speculative tasks are never seen. With mode
overwrite the files of the manifest before go after that.

Files are reached through pyarrow.fs: local paths, file, hdfs, gs, abfs and s3, as which s3a and s3n
paths are opened; any other scheme is an error that says so.

Defined cases: a null payload is empty; a record without id gets a random one, one without date the
time of writing; repeated rows are records each; an empty frame gives an archive without files, which reads as no rows;
a record cut short, or bytes that are no record, are an error; columns not in the schema are ignored.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceWriter,
    EqualTo,
    In,
    InputPartition,
    IsNotNull,
    StringStartsWith,
    WriterCommitMessage,
)

from folioscope.llm.common import Work, ship, skew_join

SCHEMA = (
    "record_id string, record_type string, target_uri string, date string, content_type string, "
    "refers_to string, payload_digest string, payload_bytes bigint, headers map<string,string>, http_head string, payload binary"
)
#: Column of the schema -> name of the record header (lower case) that holds it.
HEADER_OF = {
    "record_id": "warc-record-id",
    "record_type": "warc-type",
    "target_uri": "warc-target-uri",
    "date": "warc-date",
    "content_type": "content-type",
    "refers_to": "warc-refers-to",
    "payload_digest": "warc-payload-digest",
}
_NAME = {
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "content_type": "Content-Type",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
}


#: Fixed values of the format: profile of revisits, HTTP blocks, the extra field of gzip members, schemes that name one store.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "application/http; msgtype=response"
SKIP_LENGTHS = b"sl"
SAME_STORE = {"s3a": "s3", "s3n": "s3"}
KNOWN_STORES = {"file", "hdfs", "s3", "gs", "gcs", "abfs", "abfss"}


def _fs(path: str):
    from pyarrow import fs

    scheme = path.split(":", 1)[0] if re.match("[A-Za-z][A-Za-z0-9+.-]*:/", path) else ""
    if not scheme:
        return fs.LocalFileSystem(), path
    scheme, rest = SAME_STORE.get(scheme, scheme), path.split(":", 1)[1]
    if scheme not in KNOWN_STORES:
        raise ValueError(f"archives can't be reached through {scheme}: use one of {', '.join(sorted(KNOWN_STORES))}")
    return fs.FileSystem.from_uri(f"{scheme}:{rest if rest.startswith('//') else '//' + rest}")


def member(record: bytes, level: int = 4) -> bytes:
    """A gzip member that says how long it is, compressed and not, where both fit in 32 bits."""
    z = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = z.compress(record) + z.flush() + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)
    size = 24 + len(body)
    if max(size, len(record)) >> 32:
        return struct.pack("<BBBBIBB", 31, 139, 8, 0, 0, 0, 255) + body
    return struct.pack("<BBBBIBBH2sHII", 31, 139, 8, 4, 0, 0, 255, 12, SKIP_LENGTHS, 8, size, len(record)) + body


class _Stream:
    """Bytes of a plain file or of gzip members, with cheap skipping. `inflated` counts what was decompressed."""

    def __init__(self, raw, gz: bool) -> None:
        self.raw, self.gz, self.buf = raw, gz, bytearray()
        self.un, self.packed, self.next_member, self.inflated = None, b"", None, 0

    def _begin(self) -> bool:
        """At the start of a member: reads its header, and where the next one begins, if it says so."""
        while len(self.packed) < 12 and (data := self.raw.read(1 << 16)):
            self.packed += data
        if not self.packed:
            return False
        start, self.next_member = self.raw.tell() - len(self.packed), None
        if len(self.packed) >= 12 and self.packed[3] & 4:
            (n,) = struct.unpack_from("<H", self.packed, 10)
            while len(self.packed) < 12 + n and (data := self.raw.read(1 << 16)):
                self.packed += data
            at, end = 12, min(12 + n, len(self.packed))
            while at + 4 <= end:
                name, (size,) = self.packed[at : at + 2], struct.unpack_from("<H", self.packed, at + 2)
                if name == SKIP_LENGTHS and size >= 4 and at + 8 <= end:
                    self.next_member = start + struct.unpack_from("<I", self.packed, at + 4)[0]
                at += 4 + size
        self.un = zlib.decompressobj(31)
        return True

    def _more(self, most: int = 1 << 18) -> bytes:
        """Some further bytes; none at the end."""
        if not self.gz:
            return self.raw.read(most)
        while True:
            if self.un is None and not self._begin():
                return b""
            data = self.packed or self.raw.read(1 << 16)
            if not data:
                raise ValueError("archive ends within a record")
            out = self.un.decompress(data, most)
            self.packed = self.un.unconsumed_tail
            if self.un.eof:
                self.packed, self.un = self.un.unused_data, None
            self.inflated += len(out)
            if out:
                return out

    def until(self, mark: bytes) -> bytes | None:
        at = 0
        while (i := self.buf.find(mark, at)) < 0:
            at = max(0, len(self.buf) - len(mark))
            if not (data := self._more(4096 if self.gz else 1 << 18)):
                return None
            self.buf += data
        out = bytes(self.buf[:i])
        del self.buf[: i + len(mark)]
        return out

    def take(self, n: int) -> bytes:
        while len(self.buf) < n:
            if not (data := self._more()):
                raise ValueError("archive ends within a record")
            self.buf += data
        out = bytes(self.buf[:n])
        del self.buf[:n]
        return out

    def skip(self, n: int) -> None:
        """Past the n bytes that are left of a record."""
        if n <= len(self.buf):
            del self.buf[:n]
            return
        n -= len(self.buf)
        self.buf.clear()
        if not self.gz:  # nothing of it need be read at all
            end = self.raw.tell() + n
            if end > self.raw.size():
                raise ValueError("archive ends within a record")
            self.raw.seek(end)
        elif self.un is not None and self.next_member is not None and self.next_member <= self.raw.size():
            self.raw.seek(self.next_member)  # a record is a member: the rest of it is never inflated
            self.un, self.packed = None, b""
        else:
            while n > 0:
                if not (data := self._more()):
                    raise ValueError("archive ends within a record")
                self.buf += data[n:]
                n -= len(data)


def parse_headers(block: bytes) -> dict[str, str]:
    """Header lines of a record after its version line; names in lower case, continuation lines joined."""
    out: dict[str, str] = {}
    last = ""
    for line in block.decode("utf-8", "replace").split("\r\n"):
        if line[:1] in (" ", "\t") and last:
            out[last] += " " + line.strip()
        elif ":" in line:
            last, value = line.split(":", 1)
            last = last.strip().lower()
            out[last] = value.strip()
    return out


def bare(column: str, value: str | None) -> str | None:
    """A header's value as its column has it: identifiers without brackets, SHA-1 digests without their name."""
    if value is None:
        return None
    if column in ("record_id", "refers_to"):
        return value.removeprefix("<").removesuffix(">")
    return value[5:] if column == "payload_digest" and value.lower().startswith("sha1:") else value


@dataclass
class ArchivePart(InputPartition):
    path: str

    def __init__(self, path: str) -> None:
        super().__init__(path)
        self.path = path


class WarcReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path = options["path"]
        self.payload = str(options.get("payload", "true")).lower() == "true"
        self.tests: list[tuple[str, str, tuple]] = []

    def pushFilters(self, filters):
        for f in filters:
            col = ".".join(f.attribute) if hasattr(f, "attribute") else ""
            if col in HEADER_OF and isinstance(f, EqualTo):
                self.tests.append((col, "in", (f.value,)))
            elif col in HEADER_OF and isinstance(f, In):
                self.tests.append((col, "in", tuple(f.value)))
            elif col in HEADER_OF and isinstance(f, StringStartsWith):
                self.tests.append((col, "starts", (f.value,)))
            elif col in HEADER_OF and isinstance(f, IsNotNull):
                self.tests.append((col, "there", ()))
            else:
                yield f

    def partitions(self):
        from pyarrow import fs

        at, root = _fs(self.path)
        info = at.get_file_info(root)
        if info.type == fs.FileType.File:
            return [ArchivePart(self.path)]
        base = self.path.rstrip("/")
        manifest = at.get_file_info(f"{root}/_manifest")
        if manifest.type == fs.FileType.File:
            with at.open_input_stream(f"{root}/_manifest") as f:
                return [ArchivePart(f"{base}/{x}") for x in json.loads(f.read())]
        found = at.get_file_info(fs.FileSelector(root))
        return [ArchivePart(f"{base}/{x.base_name}") for x in sorted(found, key=lambda x: x.path) if x.base_name.endswith((".warc", ".warc.gz"))]

    def _wanted(self, headers: dict[str, str]) -> bool:
        for column, kind, values in self.tests:
            x = bare(column, headers.get(HEADER_OF[column]))
            if x is None or kind == "in" and x not in values or kind == "starts" and not x.startswith(values[0]):
                return False
        return True

    def read(self, partition):
        if partition is None or not getattr(partition, "path", None):
            return
        at, path = _fs(partition.path)
        gz = path.endswith(".gz")
        with at.open_input_file(path) as raw:
            s = _Stream(raw, gz)
            while True:
                block = s.until(b"\r\n\r\n")
                if block is None:
                    if s.buf.strip():
                        raise ValueError(f"{path}: not a WARC record")
                    return
                version, _, rest = block.lstrip(b"\r\n").partition(b"\r\n")
                if not version.startswith(b"WARC/"):
                    raise ValueError(f"{path}: not a WARC record")
                headers = parse_headers(rest)
                n = int(headers.get("content-length", 0))
                if not self._wanted(headers):
                    s.skip(n + 4)
                    continue
                head, payload, own = None, None, n
                http = headers.get("content-type", "").lower().startswith("application/http")
                if self.payload:
                    payload = s.take(n)
                    s.skip(4)
                    if http:
                        head, mark, payload = payload.partition(b"\r\n\r\n")
                        head, own = (head + mark).decode("utf-8", "replace"), len(payload)
                else:
                    s.skip(n + 4)
                    own = None if http else n  # how long the head is isn't known
                full = headers.get("warc-x-payload-length")
                yield (
                    *(bare(c, headers.get(HEADER_OF[c])) for c in HEADER_OF),
                    int(full) if full is not None else own,
                    headers,
                    head,
                    payload,
                )


@dataclass
class Written(WriterCommitMessage):
    files: list


class WarcWriter(DataSourceWriter):
    """Rows with the columns of SCHEMA (headers may be missing); a null payload is empty."""

    def __init__(self, options: dict, overwrite: bool) -> None:
        self.path = options["path"].rstrip("/")
        self.overwrite = overwrite
        self.gz = str(options.get("gzip", "true")).lower() == "true"
        self.limit = int(options.get("max_file_bytes", 256 << 20))
        self.date = options.get("date") or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

    def _open(self, at, root):
        name = f"part-{uuid.uuid4().hex}.warc" + ".gz" * self.gz
        return name, at.open_output_stream(f"{root}/{name}", compression=None)

    def write(self, iterator: Iterator) -> Written:
        at, root = _fs(self.path)
        at.create_dir(root, recursive=True)
        files, out, size = [], None, 0
        for row in iterator:
            r = row.asDict()
            http = r.get("http_head")
            block = (http or "").encode() + bytes(r.get("payload") or b"")
            r |= {"record_id": r.get("record_id") or f"urn:uuid:{uuid.uuid4()}", "date": r.get("date") or self.date}
            if http:
                r["content_type"] = HTTP
            for c in ("record_id", "refers_to"):
                if r.get(c):
                    r[c] = f"<{bare(c, r[c])}>"
            if re.fullmatch("[A-Z2-7]{32}", r.get("payload_digest") or ""):
                r["payload_digest"] = "sha1:" + r["payload_digest"]
            head = ["WARC/1.1"]
            head += [f"{_NAME[c]}: {' '.join(str(r[c]).split())}" for c in _NAME if r.get(c) is not None]
            if r.get("record_type") == "revisit":
                head.append(f"WARC-Profile: {PROFILE}")
            if r.get("payload_bytes") is not None:
                head.append(f"WARC-X-Payload-Length: {r['payload_bytes']}")
            head.append(f"Content-Length: {len(block)}")
            record = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
            if self.gz:
                record = member(record)
            if out is None or size + len(record) > self.limit and size:
                if out is not None:
                    out.close()
                name, out = self._open(at, root)
                files.append(name)
                size = 0
            out.write(record)
            size += len(record)
        if out is not None:
            out.close()
        return Written(files)

    def commit(self, messages) -> None:
        at, root = _fs(self.path)
        at.create_dir(root, recursive=True)
        names, before = [x for m in messages if m is not None for x in m.files], []
        if at.get_file_info(f"{root}/_manifest").is_file:
            with at.open_input_stream(f"{root}/_manifest") as f:
                before = json.loads(f.read())
        with at.open_output_stream(f"{root}/_manifest") as f:
            f.write(json.dumps(names if self.overwrite else before + names).encode())
        for x in before if self.overwrite else []:  # no reader finds them any more
            at.delete_file(f"{root}/{x}")

    def abort(self, messages) -> None:
        at, root = _fs(self.path)
        for m in messages:
            for x in m.files if m is not None else []:
                at.delete_file(f"{root}/{x}")


class WarcSource(DataSource):
    """spark.read.format("warc").load(path) and df.write.format("warc").save(path).

    Options: payload (true/false), gzip (true/false), max_file_bytes, date (WARC-Date of records without one).
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool):
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def base32_sha1(c: F.Column) -> F.Column:
    """SHA-1 as 32 base-32 characters: 5 hex digits are 4 of them."""
    h = F.sha1(c)
    parts = [F.lpad(F.conv(F.substring(h, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def to_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Records of pages(page_id, url, html): the first page of each payload as response, the others as revisits of it.

    Only payloads of at least `min_bytes` are shared; smaller ones are always
    responses. A null html is an empty payload. Rows with the smallest page_id
    of a payload are all responses, should that id repeat; a row without
    page_id is a response. Other columns are ignored.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumns(
        {"payload_digest": base32_sha1(F.col("html").cast("binary")), "payload_bytes": F.octet_length("html").cast("bigint")}
    )
    first = (
        rows.where((F.col("payload_bytes") >= min_bytes) & F.col("page_id").isNotNull())
        .groupBy("payload_digest", "payload_bytes")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )
    # Roles are found on rows without payloads; only a page that repeats another meets its id again.
    later = (
        skew_join(rows.select("page_id", "payload_digest", "payload_bytes").where("page_id is not null"), first, ["payload_digest", "payload_bytes"], "n", "page_id")
        .where("page_id > first_id")
        .select("page_id", "payload_digest", "payload_bytes", "first_id")
        .distinct()
    )
    joined = rows.join(later, ["page_id", "payload_digest", "payload_bytes"], "left")
    urn = lambda c: F.concat(F.lit("urn:page:"), c.cast("string"))
    again = F.col("first_id").isNotNull()
    return joined.select(
        urn(F.col("page_id")).alias("record_id"),
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.col("url").alias("target_uri"),
        F.lit(None).cast("string").alias("date"),
        F.lit(None).cast("string").alias("content_type"),
        F.when(again, urn(F.col("first_id"))).alias("refers_to"),
        "payload_digest",
        "payload_bytes",
        F.lit(None).cast("map<string,string>").alias("headers"),
        F.when(~again, F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n")).alias("http_head"),
        F.when(~again, F.col("html").cast("binary")).alias("payload"),
    )


def write_warc(records: DataFrame, path: str, gzip: bool = True) -> None:
    register(records.sparkSession)
    records.write.format("warc").option("gzip", str(gzip).lower()).mode("append").save(path)


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def op6_warc(spark, sf_dir: str) -> DataFrame:
    path = Work(spark, "warc").path("archives")
    write_warc(to_records(spark.read.parquet(f"{sf_dir}/pages.parquet"), min_bytes=0), path)
    back = read_warc(spark, path)
    own_digest = base32_sha1(F.col("payload"))
    own_bytes = F.octet_length("payload").cast("bigint")
    response = F.col("record_type") == "response"
    page = lambda c: F.when(c.startswith("urn:page:"), F.substring_index(c, ":", -1).try_cast("bigint"))
    # A response's digest and length are taken anew from the payload that was read back.
    return back.select(
        page(F.col("record_id")).alias("page_id"),
        F.when(response, own_bytes).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(response, own_digest).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        page(F.col("refers_to")).alias("refers_to"),
    )


OP6_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages
), f AS (
  SELECT page_id, strlen(h) AS n, x, min(page_id) OVER (PARTITION BY x, strlen(h)) AS first_id FROM p
)
SELECT page_id, n AS payload_bytes,
  (SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
     1 + CAST((CAST('0x' || substr(x, CAST(1 + 5 * (i // 4) AS INT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31 AS INT), 1), '' ORDER BY i)
   FROM range(32) r(i)) AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM f
"""
