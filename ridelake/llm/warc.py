"""Conversion of legacy ARC archives to WARC.

An ARC file starts with a version block, ``filedesc://...``, whose lines give
the version and the field names of the header lines that follow. Each record
is one header line, as many bytes as its last field declares, and a newline.
The converter reads records by those fields, and synthesises WARC records:
identifier, ISO timestamp, type, block and payload digests. Records whose
payload another record already holds become revisits of it.

Archives are gzipped text files written by Spark's text sink, whose line
separator is the byte sequence that ends a record; every file starts with a
version block (ARC) or a warcinfo record (WARC) and holds at most ``RECORDS_PER_FILE`` records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import staged

RECORDS_PER_FILE = 2000
MIN_REVISIT_BYTES = 0   # smaller payloads are stored each time
KEY_HEADER = "X-Page-Id"
# Fixed values of the formats.
ARC_FIELDS = {
    "1": "URL IP-address Archive-date Content-type Archive-length",
    "2": "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
CRLF2 = b"\r\n\r\n"


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# ---- ARC ------------------------------------------------------------------

def arc_version_block(version: str) -> bytes:
    body = f"{version} 0 converter\n{ARC_FIELDS[version]}\n\n".encode()
    extra = {"1": "", "2": "200 - - 0 archive.arc "}[version]
    return f"filedesc://archive.arc 0.0.0.0 20000101000000 text/plain {extra}{len(body)}\n".encode() + body


def arc_record(version: str, url: str | None, key: str | None, payload: bytes) -> bytes:
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n"
            + (f"{KEY_HEADER}: {key}\r\n" if key is not None else "") + "\r\n").encode()
    address = quote(url or "about:blank", safe=":/?#[]@!$&'()*+,;=%~") or "about:blank"
    extra = {"1": "", "2": "200 - - 0 archive.arc "}[version]
    return f"{address} 0.0.0.0 20000101000000 text/html {extra}{len(http) + len(payload)}\n".encode() + http + payload


def arc_records(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """``(offset, header fields, content)`` of each record after the version block, by declared lengths."""
    at, fields = 0, None
    while at < len(data):
        if data[at:at + 1] == b"\n":  # the separator after a record
            at += 1
            continue
        end = data.index(b"\n", at)
        values = data[at:end].decode("utf-8", "replace").split(" ")
        length = int(values[-1])
        content = data[end + 1:end + 1 + length]
        if len(content) < length:
            raise ValueError(f"the archive ends inside the record at {at}")
        if fields is None or values[0].startswith("filedesc://"):
            version = content.split(b" ", 1)[0].decode()
            fields = content.split(b"\n")[1].decode().split(" ")
            if version not in ARC_FIELDS or fields != ARC_FIELDS[version].split(" "):
                raise ValueError(f"not an ARC version block: {content[:60]!r}")
        else:
            if len(values) != len(fields):
                raise ValueError(f"a header line of {len(values)} fields at {at}; the version block names {len(fields)}")
            yield at, dict(zip(fields, values)), content
        at = end + 1 + length


def write_arc(pages: DataFrame, path: str, key_col: str, url_col: str, payload_col: str, version: str = "1",
              records_per_file: int = RECORDS_PER_FILE) -> None:
    """Pages as ARC files: a version block and at most ``records_per_file`` records each."""
    rows = pages.select(F.col(key_col).cast("string").alias("k"), F.col(url_col).cast("string").alias("u"),
                        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("p"))

    def lines(batches):
        n = 0
        for pdf in batches:
            out = []
            for k, u, p in zip(pdf["k"], pdf["u"], pdf["p"]):
                if n % records_per_file == 0:
                    out.append(arc_version_block(version).removesuffix(b"\n"))
                n += 1
                out.append(arc_record(version, u, k, p.encode()))
            yield pd.DataFrame({"value": out})

    _write_lines(rows.mapInPandas(lines, "value binary"), path, "\n", records_per_file)


def _write_lines(df: DataFrame, path: str, separator: str, records_per_file: int) -> None:
    (df.select(F.col("value").cast("string")).write.mode("append").option("lineSep", separator)
     .option("compression", "gzip").option("maxRecordsPerFile", records_per_file + 1).text(path))


def read_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


# ---- WARC -----------------------------------------------------------------

def record_id(file: str, offset: int) -> str:
    """A stable identifier: a name-based UUID over the place of the record in its ARC file."""
    h = bytearray(hashlib.sha1(f"{file}@{offset}".encode()).digest()[:16])
    h[6], h[8] = h[6] & 0x0F | 0x80, h[8] & 0x3F | 0x80
    x = h.hex()
    return f"<urn:uuid:{x[:8]}-{x[8:12]}-{x[12:16]}-{x[16:20]}-{x[20:]}>"


def iso_time(arc_date: str) -> str:
    d = arc_date.ljust(14, "0")[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def split_http(content: bytes) -> tuple[bytes, bytes]:
    """HTTP head with its empty line, and payload; content without a head is all payload."""
    if not content.startswith(b"HTTP/"):
        return b"", content
    head, sep, payload = content.partition(CRLF2)
    return head + sep, payload


def http_field(head: bytes, name: str) -> str | None:
    for line in head.split(b"\r\n")[1:]:
        k, _, v = line.partition(b":")
        if k.strip().lower() == name.lower().encode():
            return v.strip().decode("utf-8", "replace")
    return None


def warc_record(kind: str, identifier: str, date: str, block: bytes, content_type: str, more: dict[str, str | None]) -> bytes:
    """Header and block; the file's record separator completes it."""
    head = {"WARC-Type": kind, "WARC-Record-ID": identifier, "WARC-Date": date, "Content-Type": content_type,
            "WARC-Block-Digest": "sha1:" + sha1_base32(block), **more, "Content-Length": str(len(block))}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items() if v is not None)
    return b"WARC/1.0\r\n" + lines.encode() + b"\r\n" + block


def warc_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """``(header, block)`` of each record, by declared lengths; damaged archives raise."""
    at = 0
    while at < len(data):
        end = data.find(CRLF2, at)
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")
        if end < 0 or not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at {at}")
        head = dict(x.split(": ", 1) for x in lines[1:])
        begin = end + 4
        at = begin + int(head["Content-Length"])
        block = data[begin:at]
        if data[at:at + 4] != CRLF2:
            raise ValueError(f"the record before {at} is longer or shorter than it declares")
        if head.get("WARC-Block-Digest") != "sha1:" + sha1_base32(block):
            raise ValueError(f"the block before {at} has another digest than it declares")
        at += 4
        yield head, block


def _base(path: str) -> str:
    return path.rsplit("/", 1)[-1]


def convert(spark: SparkSession, arc_path: str, warc_path: str, min_bytes: int = MIN_REVISIT_BYTES,
            records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write the WARC form of the ARC files below ``arc_path``.

    Of records with equal payloads (of ``min_bytes`` or more) the one with the
    smallest key is a response, ties by place; the others are revisits of it.
    Records without a key come last. Two passes: the first yields a row of keys and digest per
    record, grouped by digest; the second writes each file's records with the
    revisits that the first found in it.
    """
    def places(batches):
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                out = []
                for offset, _, body in arc_records(gzip.decompress(content)):
                    head, payload = split_http(body)
                    out.append((path, offset, http_field(head, KEY_HEADER), hashlib.sha1(payload).digest(), len(payload)))
                yield pd.DataFrame(out, columns=["path", "offset", "key", "digest", "n"])

    files = read_files(spark, arc_path)
    seen = staged(files.mapInPandas(places, "path string, offset long, key string, digest binary, n long")
                  .filter(F.col("n") >= min_bytes), "arc-places")
    number = F.expr("try_cast(key as bigint)")
    place = F.struct(number.isNull().alias("a"), number.alias("b"), F.col("key").isNull().alias("c"),
                     F.col("key").alias("key"), F.col("path").alias("path"), F.col("offset").alias("offset"))
    first = staged(seen.groupBy("digest").agg(F.min(place).alias("_first"), F.count("*").alias("_n"))
                   .filter("_n > 1").select(F.col("digest").alias("_digest"), "_first"), "arc-first")
    again = (seen.join(first, F.col("digest") == F.col("_digest"))
             .filter(~((F.col("path") == F.col("_first.path")) & (F.col("offset") == F.col("_first.offset"))))
             .groupBy("path").agg(F.collect_list(F.struct(
                 F.col("offset").alias("offset"), F.col("_first.key").alias("key"), F.col("_first.path").alias("path"),
                 F.col("_first.offset").alias("at"))).alias("again")))  # at most a file's records
    again = staged(again.withColumnRenamed("path", "_path"), "arc-revisits")

    def rewrite(batches):
        n = 0
        for batch in batches:
            for path, content, again in zip(*(batch.column(c) for c in ("path", "content", "again"))):
                path, out = path.as_py(), []
                revisits = {r["offset"]: r for r in again.as_py() or ()}
                for offset, fields, body in arc_records(gzip.decompress(content.as_py())):
                    if n % records_per_file == 0:
                        out.append(warc_record("warcinfo", record_id(path, -1 - n), "2000-01-01T00:00:00Z",
                                               f"format: WARC File Format 1.0\r\nisPartOf: {_base(path)}\r\n".encode(),
                                               "application/warc-fields", {}))
                    n += 1
                    head, payload = split_http(body)
                    first = revisits.get(offset)
                    more = {"WARC-Target-URI": fields["URL"], "WARC-IP-Address": fields["IP-address"],
                            "WARC-Payload-Digest": "sha1:" + sha1_base32(payload)}
                    if first:
                        more |= {"WARC-Profile": PROFILE, "WARC-Refers-To": record_id(first["path"], first["at"]),
                                 "WARC-Refers-To-Key": first["key"], "WARC-Truncated": "length"}
                    kind = "revisit" if first else "response" if head else "resource"
                    out.append(warc_record(kind, record_id(path, offset), iso_time(fields["Archive-date"]),
                                           head if first else body,
                                           "application/http; msgtype=response" if head else fields["Content-type"], more))
                yield _binary(out)

    with_revisits = files.join(again, files["path"] == again["_path"], "left").select("path", "content", "again")
    _write_lines(with_revisits.mapInArrow(rewrite, "value binary"), warc_path, "\r\n\r\n", records_per_file)


def _binary(values: list[bytes]):
    import pyarrow as pa
    return pa.RecordBatch.from_arrays([pa.array(values, pa.binary())], ["value"])


def read_warc(spark: SparkSession, warc_path: str) -> DataFrame:
    """One row per response, resource or revisit: key, uri, id, date, type, payload size and digest, what it refers to.

    Sizes and digests are of the full payload: of a response as found in its
    block (another digest than declared raises), of a revisit as declared.
    """
    def parse(batches):
        for pdf in batches:
            for content in pdf["content"]:
                out = []
                for head, block in warc_records(gzip.decompress(content)):
                    if head["WARC-Type"] == "warcinfo":
                        continue
                    http, payload = split_http(block)
                    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                    if head["WARC-Type"] == "revisit":
                        size = int(http_field(http, "Content-Length") or 0)
                    else:
                        size = len(payload)
                        if sha1_base32(payload) != digest:
                            raise ValueError(f"{head['WARC-Record-ID']}: the payload has another digest than declared")
                    out.append((http_field(http, KEY_HEADER), unquote(head["WARC-Target-URI"]), head["WARC-Record-ID"],
                                head["WARC-Date"], head["WARC-Type"], size, digest, head.get("WARC-Refers-To"),
                                head.get("WARC-Refers-To-Key")))
                yield pd.DataFrame(out, columns=["key", "uri", "record_id", "date", "record_type", "payload_bytes",
                                                 "payload_digest", "refers_to_id", "refers_to"])

    return read_files(spark, warc_path).mapInPandas(
        parse, "key string, uri string, record_id string, date string, record_type string, payload_bytes long, "
               "payload_digest string, refers_to_id string, refers_to string")


def archive_pages(pages: DataFrame, key_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                  version: str = "1", min_bytes: int = MIN_REVISIT_BYTES,
                  records_per_file: int = RECORDS_PER_FILE) -> DataFrame:
    """Pages to ARC files, these to WARC files (both below the checkpoint folder), and those read back: a row per page.

    Null payloads are empty, and equal payloads from ``min_bytes`` on are
    revisits whatever their length; a null url is ``about:blank``. Rows with
    equal keys and payloads: the first in place is the response. Null keys come
    back null and are responses only where no row with a key has their payload.
    An empty table gives no rows. Other columns are ignored.
    """
    spark = pages.sparkSession
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    write_arc(pages, arc, key_col, url_col, payload_col, version, records_per_file)
    convert(spark, arc, warc, min_bytes, records_per_file)
    kind = dict(pages.select(key_col).dtypes)[key_col]
    back = read_warc(spark, warc)
    return back.select(F.col("key").cast(kind).alias(key_col), "payload_bytes", "payload_digest", "record_type",
                       F.col("refers_to").cast(kind).alias("refers_to"), "record_id", "uri")
