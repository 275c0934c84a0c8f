"""Web archives: legacy ARC records in, WARC records out.

An ARC file starts with a version block that names the fields of its header lines; version 1 lines
have five fields, version 2 lines ten, and the last one declares the length of what follows. The
reader walks a file by these lengths, so payloads may hold any bytes. Conversion keeps the content
and gives each record a name-based identifier (of file, offset and header line), an ISO timestamp, a
type by content (a response has an HTTP status line, whatever the scheme of its URL, and a resource has
none), and digests of block and payload. Among records with equal payloads of at least
``REVISIT_BYTES`` bytes one stays as it is, a response where there is one, and the others become
revisits without payload.

Files are written with Spark's text writer, whose line separator is the end of a record; a partition
is a file, and the first row of each carries the version block or the warcinfo record. Files are read
as binary rows, decompressed and parsed record by record, so a task holds one compressed file and one
record. Files are as large as the partitions they come from (``spark.sql.files.maxPartitionBytes``).

Defined results: a null payload is empty; a null key is written as none and read as null, and ranks
below all others; records that are equal in everything are records of their own, the last in file order
ranks highest; a null URL becomes ``http://invalid/``; white space in URLs is escaped; an empty table
gives files without records. Further columns of the input are not archived.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.common import stored

REVISIT_BYTES = 1000
ARC_DATE = "20000101000000"
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
KEY_HEADER = "X-Record-Key"
#: Of a revisit without an HTTP header that tells the length of its payload.
SIZE_HEADER = "X-Payload-Length"
CHUNK = 1 << 20


def _bytes(c: Column | str) -> Column:
    return (F.lit(c) if isinstance(c, str) else c).cast("binary")


def _write(records: DataFrame, path: str, end: str) -> None:
    """``record`` (binary) rows as gzip files; the text writer passes bytes through as they are."""
    records.select(F.col("record").cast("string").alias("value")).write.option("lineSep", end).option("compression", "gzip").text(path)


def _first_of_file() -> Column:
    return F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0


def write_arc(pages: DataFrame, path: str, key: str, url: str, payload: str, date: str = ARC_DATE) -> None:
    """One ARC record per row with an HTTP response as content. Files alternate between header
    versions 1 and 2; the key travels in a header of the response."""
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    size = F.octet_length(body)
    keyed = F.coalesce(F.concat(F.lit(f"\r\n{KEY_HEADER}: "), F.col(key).cast("string")), F.lit(""))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size, keyed, F.lit("\r\n\r\n"))
    content = F.concat(_bytes(head), body)
    address = F.coalesce(F.regexp_replace(url, r"[\s\p{Cntrl}]", "%20"), F.lit("http://invalid/"))
    version = 1 + F.pmod(F.spark_partition_id(), F.lit(2))

    def block(v: int) -> str:
        text = f"{v} 0 pages\n{ARC_FIELDS[v]}\n"
        extra = "" if v == 1 else "200 - - 0 pages.arc "
        return f"filedesc://pages.arc 0.0.0.0 {date} text/plain {extra}{len(text)}\n{text}\n"

    rows = pages.select(address.alias("address"), content.alias("content"), version.alias("version"), _first_of_file().alias("first"))
    common = F.concat_ws(" ", "address", F.lit("0.0.0.0"), F.lit(date), F.lit("text/html"))
    one = F.concat_ws(" ", common, F.octet_length("content"))
    two = F.concat_ws(" ", common, F.lit("200 - - 0 pages.arc"), F.octet_length("content"))
    start = F.when(F.col("first"), F.when(F.col("version") == 1, block(1)).otherwise(block(2))).otherwise("")
    line = F.concat(start, F.when(F.col("version") == 1, one).otherwise(two), F.lit("\n"))
    _write(rows.select(F.concat(_bytes(line), F.col("content")).alias("record")), path, "\n")


class _Stream:
    """Bytes of a file, decompressed as they are asked for when it is a gzip file of any members."""

    def __init__(self, raw: bytes):
        self.raw, self.at, self.buffer, self.offset = raw, 0, bytearray(), 0
        self.gzip = zlib.decompressobj(31) if raw[:2] == b"\x1f\x8b" else None

    def _fill(self) -> bool:
        if self.at >= len(self.raw):
            return False
        piece = self.raw[self.at:self.at + CHUNK // 8]
        self.at += len(piece)
        if self.gzip is None:
            self.buffer += piece
            return True
        while piece:
            self.buffer += self.gzip.decompress(piece)
            piece = self.gzip.unused_data
            if self.gzip.eof:
                self.gzip = zlib.decompressobj(31)
        return True

    def take(self, n: int) -> bytes:
        while len(self.buffer) < n and self._fill():
            pass
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        self.offset += len(out)
        return out

    def until(self, mark: bytes) -> bytes:
        """Up to and with the mark; what is left when it does not come."""
        start = 0
        while (found := self.buffer.find(mark, start)) < 0:
            start = max(0, len(self.buffer) - len(mark) + 1)
            if not self._fill():
                return self.take(len(self.buffer))
        return self.take(found + len(mark))


def arc_records(raw: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Offset, header fields by name, and content of every record behind the version block."""
    stream, names = _Stream(raw), None
    while True:
        offset = stream.offset
        line = stream.until(b"\n")
        if not line:
            return
        if not line.strip():
            continue
        count = len(names) if names else (5 if len(line.split(b" ")) == 5 else 10)
        parts = line.decode("utf-8", "replace").rstrip("\r\n").rsplit(" ", count - 1)
        content = stream.take(int(parts[-1]))
        if names is None:
            # The first record describes the file: version line, then the names of the fields.
            names = content.decode("latin-1").split("\n")[1].split(" ")
            continue
        yield offset, dict(zip(names, parts, strict=True)), content


def split_http(content: bytes) -> tuple[bytes, bytes]:
    """Header block with its blank line, and payload; no header when there is no status line."""
    if not content.startswith(b"HTTP/"):
        return b"", content
    head, sep, body = content.partition(b"\r\n\r\n")
    return head + sep, body


def http_field(head: bytes, name: str) -> str | None:
    for line in head.split(b"\r\n")[1:]:
        field, _, value = line.partition(b":")
        if field.decode("latin-1").lower() == name.lower():
            return value.strip().decode("utf-8", "replace")
    return None


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _key(head: bytes) -> int | None:
    value = http_field(head, KEY_HEADER)
    return int(value) if value is not None else None


ARC_ROW = ("file string, place bigint, record_id string, uri string, stamp string, kind string, type string, key bigint, "
           "http binary, payload binary, payload_bytes bigint, payload_digest string, block_digest string")


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def read_arc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records of ARC files with what their WARC records need; ``payloads=False`` leaves contents out."""

    def rows(file: str, raw: bytes) -> Iterator[tuple]:
        name = file.rsplit("/", 1)[-1]
        for place, field, content in arc_records(raw):
            head, body = split_http(content)
            uri, date = field["URL"], field["Archive-date"]
            stamp = f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z"
            ident = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name} {place} {uri}')}>"
            yield (name, place, ident, uri, stamp, "response" if head else "resource", field["Content-type"], _key(head),
                   head if payloads else None, body if payloads else None, len(body), _sha1(body), _sha1(content) if payloads else None)

    return _files(spark, path).mapInArrow(_parser(rows, ARC_ROW), ARC_ROW)


def _parser(rows, ddl: str):
    """An Arrow function over ``(path, content)`` rows that yields records in batches of bounded bytes."""
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(T.StructType.fromDDL(ddl))

    def batch(held: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for files in batches:
            for k in range(files.num_rows):
                held, size = [], 0
                for row in rows(files.column(0)[k].as_py(), files.column(1)[k].as_py()):
                    held.append(row)
                    size += sum(len(v) for v in row if isinstance(v, bytes)) + 300
                    if size > 4 * CHUNK:
                        yield batch(held)
                        held, size = [], 0
                if held:
                    yield batch(held)

    return run


def revisits(records: DataFrame) -> DataFrame:
    """``(file, place)`` of the records that repeat a payload, and the record they refer to.

    Of equal payloads a response is kept before a resource, then the largest key, then the last in file
    order. Each task reduces its
    records to one per digest ahead of the shuffle; the join moves keys and digests only.
    """
    large = records.where(F.col("payload_bytes") >= REVISIT_BYTES)
    rank = F.struct((F.col("kind") == "response").alias("response"), "key", "file", "place", "record_id", "uri", "stamp")
    kept = large.groupBy("payload_digest").agg(F.max(rank).alias("to"), F.count("*").alias("copies")).where("copies > 1")
    copies = large.select("payload_digest", "file", "place").join(kept, "payload_digest")
    return copies.where((F.col("file") != F.col("to.file")) | (F.col("place") != F.col("to.place"))).select(
        "file", "place", F.struct("to.record_id", "to.uri", "to.stamp").alias("to"))


def convert(spark: SparkSession, arc: str, warc: str) -> None:
    """Convert ARC files to WARC files: one warcinfo record per file, then a record per ARC record.

    Payloads are shuffled once, by the place of the record, so copies do not gather in a task. The files are
    read twice: once for keys and digests, which are stored and serve both sides of the search for copies,
    and once for the contents.
    """
    narrow = read_arc(spark, arc, payloads=False).drop("http", "payload", "type", "block_digest")
    again = revisits(stored(narrow, "arc-digests"))
    rows = read_arc(spark, arc).join(again, ["file", "place"], "left")
    repeat = F.col("to").isNotNull()
    block = F.when(repeat, F.col("http")).otherwise(F.concat("http", "payload"))
    kind = F.when(repeat, "revisit").otherwise(F.col("kind"))
    media = F.when(F.length("http") > 0, "application/http; msgtype=response").otherwise(F.col("type"))
    lines = [
        F.lit("WARC/1.0"), F.concat(F.lit("WARC-Type: "), kind), F.concat(F.lit("WARC-Record-ID: "), F.col("record_id")),
        F.concat(F.lit("WARC-Date: "), F.col("stamp")), F.concat(F.lit("WARC-Target-URI: "), F.col("uri")),
        F.concat(F.lit("WARC-Payload-Digest: "), F.col("payload_digest")),
        F.when(~repeat, F.concat(F.lit("WARC-Block-Digest: "), F.col("block_digest"))),
        F.when(repeat, F.concat(F.lit(f"WARC-Profile: {REVISIT_PROFILE}\r\nWARC-Refers-To: "), F.col("to.record_id"),
                                F.lit("\r\nWARC-Refers-To-Target-URI: "), F.col("to.uri"), F.lit("\r\nWARC-Refers-To-Date: "), F.col("to.stamp"))),
        F.when(repeat & (F.length("http") == 0), F.concat(F.lit(f"{SIZE_HEADER}: "), F.col("payload_bytes"))),
        F.concat(F.lit("Content-Type: "), media), F.concat(F.lit("Content-Length: "), F.octet_length(block)),
    ]
    head = F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"))
    made = rows.select(head.alias("head"), block.alias("block"), _first_of_file().alias("first"))
    about = "software: quern\r\nformat: WARC File Format 1.0\r\n"
    ident = F.regexp_replace(F.md5(F.concat(F.lit("warcinfo "), F.spark_partition_id())),
                             "^(.{8})(.{4}).(.{3}).(.{3})(.{12})$", "$1-$2-3$3-8$4-$5")
    info = F.concat(F.lit("WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:"), ident,
                    F.lit(f">\r\nWARC-Date: 2000-01-01T00:00:00Z\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(about)}\r\n\r\n{about}\r\n\r\n"))
    start = F.when(F.col("first"), info).otherwise("")
    _write(made.select(F.concat(_bytes(start), _bytes(F.col("head")), F.col("block")).alias("record")), warc, "\r\n\r\n")


WARC_ROW = ("record_id string, kind string, key bigint, uri string, stamp string, refers_to_id string, payload_bytes bigint, "
            "payload_digest string, sound boolean")


def warc_records(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of every record."""
    stream = _Stream(raw)
    while head := stream.until(b"\r\n\r\n"):
        lines = head.decode("utf-8", "replace").lstrip("\r\n").split("\r\n")
        if not lines[0].startswith("WARC/"):
            continue
        field = {n.strip().lower(): v.strip() for n, _, v in (x.partition(":") for x in lines[1:] if x)}
        yield field, stream.take(int(field["content-length"]))
        stream.take(4)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records other than warcinfo; digests in lower-case hex, and whether the stored ones hold."""

    def rows(_: str, raw: bytes) -> Iterator[tuple]:
        for field, block in warc_records(raw):
            kind = field["warc-type"]
            if kind == "warcinfo":
                continue
            head, body = split_http(block)
            digest = field["warc-payload-digest"]
            size, sound = len(body), True
            if kind == "revisit":
                size = int(field.get(SIZE_HEADER.lower()) or http_field(head, "Content-Length") or 0)
            else:
                sound = digest == _sha1(body) and field.get("warc-block-digest") == _sha1(block)
            yield (field["warc-record-id"], kind, _key(head), field["warc-target-uri"], field["warc-date"], field.get("warc-refers-to"),
                   size, base64.b32decode(digest.partition(":")[2]).hex(), sound)

    return _files(spark, path).mapInArrow(_parser(rows, WARC_ROW), WARC_ROW)


def with_targets(records: DataFrame) -> DataFrame:
    """``refers_to``: the key of the response that a revisit names. The records, which hold no payloads, are
    stored, so the files are parsed once. Only revisits are joined; all other records name nothing and pass by."""
    records = stored(records, "warc-records")
    again = records.where("refers_to_id is not null")
    named = again.select(F.col("refers_to_id").alias("id")).distinct()
    target = records.where("kind = 'response'").select(F.col("record_id").alias("id"), F.col("key").alias("refers_to"))
    target = target.join(named, "id", "left_semi")
    found = again.join(target.withColumnRenamed("id", "refers_to_id"), "refers_to_id", "left").select(*records.columns, "refers_to")
    return found.unionByName(records.where("refers_to_id is null").withColumn("refers_to", F.lit(None).cast("bigint")))
