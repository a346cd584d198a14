"""WARC archives of web pages: writing with Spark's text sink, reading, transaction assembly.

Each page becomes a request, a response (or revisit) and a metadata record;
request and metadata name the response in WARC-Concurrent-To. Reading joins the
three again through these identifiers into one nested row for each capture.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from functools import reduce
from operator import add

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gapwise.runtime import materialize

FILE_BYTES = 32 << 20                     # of uncompressed records in an archive file, about
SEPARATOR = "\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SCHEMA = ("record_id string, type string, concurrent_to string, refers_to string, target_uri string, "
           "fields map<string,string>, payload_bytes long, payload_digest string, payload binary")


def base32(hexed: Column) -> Column:
    """Upper-case base32 of 160 bits in hex: 32 letters, five hex digits are four of them."""
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    parts = []
    for at in range(0, 40, 5):
        number = F.conv(F.substring(hexed, at + 1, 5), 16, 10).cast("int")
        parts += [F.substring(letters, F.shiftright(number, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*parts)


def _id(kind: str, *cols: str) -> Column:
    h = F.md5(F.concat_ws("\x1f", F.lit(kind), *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in cols]))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _numbered(own: str, digit: int) -> Column:
    """An id with another first digit."""
    return F.concat(F.lit(f"<urn:uuid:{digit}"), F.substring(own, 12, 1000))


def _record(headers: list[tuple[str, Column]], *block: Column) -> Column:
    """A record of a block given in parts, which are joined once."""
    lines = [F.concat(F.lit(f"\r\n{k}: "), v) for k, v in headers]
    return F.concat(F.lit("WARC/1.1"), *[F.coalesce(x, F.lit("")) for x in lines],
                    F.lit("\r\nContent-Length: "), reduce(add, map(F.octet_length, block)).cast("string"), F.lit(SEPARATOR), *block)


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   least_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write gzip-compressed WARC 1.1 files to the folder ``path``.

    Of the pages with equal payloads of at least ``least_bytes`` bytes the one
    with the largest id is stored as response, the others are revisits that
    refer to it. Null html is an empty payload. A null id is below every other.
    White space and control characters in a URL are percent-encoded; a null URL
    has no header. Rows repeated in full give equal records. An empty table
    gives archives without records. Other columns are ignored.
    """
    src = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                       F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    src = src.withColumn("sha1", F.sha1(F.encode("html", "UTF-8"))).withColumn("bytes", F.octet_length("html"))
    groups = src.groupBy("sha1").agg(F.max("page_id").alias("stored"), F.sum(F.col("bytes").cast("long")).alias("total"),
                                     F.count("*").alias("n")).withColumn("digest", base32(F.col("sha1")))
    groups, _ = materialize(groups, "warc-digests")
    size = groups.agg(F.sum("total"), F.sum("n")).first()
    per_file = max(1, int(FILE_BYTES / ((size[0] or 0) / max(size[1] or 0, 1) + 1500))) * 3
    rows = src.join(groups.select("sha1", "digest", "stored"), "sha1")      # a payload's digest is spelt once
    revisit = (F.col("bytes") >= least_bytes) & ~F.col("page_id").eqNullSafe(F.col("stored"))
    uri = F.col("url")
    for code in [*range(33), 127]:
        if code in (9, 10, 11, 12, 13, 32, 0, 127):
            uri = F.replace(uri, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    rows = rows.select(
        "html", "page_id", "digest", revisit.alias("revisit"), uri.alias("uri"),
        _id("capture", "page_id", "digest", "url").alias("own"),
        _id("payload", "stored", "digest").alias("stored_id"))
    # A response is named by its payload, so that revisits can name it; its twin rows share the name.
    rows = rows.withColumn("own", F.when(F.col("revisit"), F.col("own")).otherwise(
        F.when(F.lit(least_bytes > 0) & (F.octet_length("html") < least_bytes), F.col("own")).otherwise(F.col("stored_id"))))
    when = F.lit(date)
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.octet_length("html").cast("string"), F.lit(SEPARATOR))
    host = F.regexp_extract("uri", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    target = F.regexp_extract("uri", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)", 1)
    common = [("WARC-Date", when), ("WARC-Target-URI", F.col("uri"))]
    request = _record([("WARC-Type", F.lit("request")), ("WARC-Record-ID", _numbered("own", 0)),
                       ("WARC-Concurrent-To", F.col("own")), *common,
                       ("Content-Type", F.lit("application/http;msgtype=request"))],
                      F.concat(F.lit("GET "), F.coalesce(target, F.lit("/")), F.lit(" HTTP/1.1\r\nHost: "),
                               F.coalesce(host, F.lit("")), F.lit(SEPARATOR)))
    response = _record([("WARC-Type", F.when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response"))),
                        ("WARC-Record-ID", F.col("own")), *common,
                        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
                        ("WARC-Profile", F.when(F.col("revisit"), F.lit(_PROFILE))),
                        ("WARC-Refers-To", F.when(F.col("revisit"), F.col("stored_id"))),
                        ("Content-Type", F.lit("application/http;msgtype=response"))],
                       http, F.when(F.col("revisit"), F.lit("")).otherwise(F.col("html")))
    metadata = _record([("WARC-Type", F.lit("metadata")), ("WARC-Record-ID", _numbered("own", 1)),
                        ("WARC-Concurrent-To", F.col("own")), *common, ("Content-Type", F.lit("application/warc-fields"))],
                       F.coalesce(F.concat(F.lit("page-id: "), F.col("page_id").cast("string"), F.lit("\r\n")), F.lit("")))
    (rows.select(F.explode(F.array(request, response, metadata)).alias("value"))
     .write.option("lineSep", SEPARATOR).option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path))


def _chunks(data: bytes, name: str, most: int = 1 << 20) -> Iterator[bytes]:
    if not name.endswith(".gz"):
        yield data
        return
    while data:                                       # a file may hold one gzip member or one for each record
        z = zlib.decompressobj(31)
        part = z.decompress(data, most)
        while part or z.unconsumed_tail:
            yield part
            part = z.decompress(z.unconsumed_tail, most)
        yield z.flush()
        data = z.unused_data


def _fields(block: bytes) -> dict[str, str]:
    out = {}
    for line in block.decode("utf-8", "replace").split("\r\n"):
        k, colon, v = line.partition(":")
        if colon:
            out[k.strip().lower()] = v.strip()
    return out


def records(data: bytes, name: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of an archive file."""
    buf, source = bytearray(), _chunks(data, name)

    def fill(n: int) -> bool:
        while len(buf) < n:
            try:
                buf.extend(next(source))
            except StopIteration:
                return False
        return True

    while True:
        while fill(1) and buf[:1] in (b"\r", b"\n"):  # the blank lines after a record
            del buf[:1]
        if not fill(1):
            return
        at, seen = -1, 0
        while at < 0:
            at = buf.find(b"\r\n\r\n", max(0, seen - 3))
            seen = len(buf)
            if at < 0 and not fill(seen + 1):
                raise ValueError(f"{name}: a record's header does not end")
        head = _fields(bytes(buf[:at]))
        n = int(head["content-length"])
        if not fill(at + 4 + n):
            raise ValueError(f"{name}: a record is cut off")
        yield head, bytes(buf[at + 4: at + 4 + n])
        del buf[: at + 4 + n]


def _parse(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("record_id", pa.string()), ("type", pa.string()), ("concurrent_to", pa.string()),
                            ("refers_to", pa.string()), ("target_uri", pa.string()),
                            ("fields", pa.map_(pa.string(), pa.string())), ("payload_bytes", pa.int64()),
                            ("payload_digest", pa.string()), ("payload", pa.binary())])
        for batch in batches:
            for i in range(batch.num_rows):
                rows, held = [], 0
                for head, block in records(batch.column(1)[i].as_py(), batch.column(0)[i].as_py()):
                    kind = head.get("warc-type")
                    fields, payload, digest, n = None, None, None, None
                    if kind == "metadata":
                        fields = list(_fields(block).items())
                    elif kind == "response":
                        payload = block.partition(b"\r\n\r\n")[2]
                        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                        n = len(payload)
                    elif kind == "revisit":
                        digest = head.get("warc-payload-digest", "").removeprefix("sha1:")
                    payload = payload if with_payload else None
                    rows.append((head.get("warc-record-id"), kind, head.get("warc-concurrent-to"),
                                 head.get("warc-refers-to"), head.get("warc-target-uri"), fields, n, digest, payload))
                    held += len(payload or b"") + 500
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
    return run


def read_records(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row for each record of the archives in a folder; digests and sizes are of the stored payloads."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(_parse(with_payload), _SCHEMA)


def captures(records_: DataFrame) -> DataFrame:
    """One nested row for each response or revisit.

    Columns: record_id, type, target_uri, payload_digest, payload_bytes,
    payload, refers_to (record id), request (struct, null without one) and
    metadata (map, null without one). Requests and metadata that name no stored
    record are left out, of several for one record the one with the largest
    record id is taken.
    """
    main = records_.where("type in ('response', 'revisit')").select(
        "record_id", "type", "target_uri", "payload_digest", "payload_bytes", "payload", "refers_to")
    request = records_.where("type = 'request' and concurrent_to is not null").groupBy("concurrent_to").agg(
        F.max(F.struct("record_id", "target_uri")).alias("request"))
    metadata = records_.where("type = 'metadata' and concurrent_to is not null").groupBy("concurrent_to").agg(
        F.max_by("fields", "record_id").alias("metadata"))
    return (main.join(request.withColumnRenamed("concurrent_to", "record_id"), "record_id", "left")
            .join(metadata.withColumnRenamed("concurrent_to", "record_id"), "record_id", "left"))


def page_captures(spark: SparkSession, path: str) -> DataFrame:
    """Per capture: page_id, payload_bytes, payload_digest, record_type, refers_to (page_id); revisits resolved."""
    parsed, _ = materialize(read_records(spark, path, with_payload=False), "warc-records")
    rows = captures(parsed).select("record_id", "type", "refers_to", "payload_bytes", "payload_digest",
                                   F.col("metadata")["page-id"].cast("long").alias("page_id"))
    stored = (rows.where("type = 'response'").groupBy(F.col("record_id").alias("refers_to"))
              .agg(F.max("page_id").alias("stored_page"), F.max("payload_bytes").alias("stored_bytes"),
                   F.max("payload_digest").alias("stored_digest")))
    stored, _ = materialize(stored, "warc-stored")
    return rows.join(stored, "refers_to", "left").select(
        "page_id", F.coalesce("payload_bytes", "stored_bytes").alias("payload_bytes"),
        F.coalesce("stored_digest", "payload_digest").alias("payload_digest"), F.col("type").alias("record_type"),
        F.col("stored_page").alias("refers_to"))
