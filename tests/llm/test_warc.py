"""Archive conversion: round trips, both header versions, revisits against a plain computation."""

import base64
import gzip
import hashlib

import pytest
from cases import prose
from pyspark.sql import functions as F

from ridelake.llm import warc as W
from ridelake.session import scratch_path

SCHEMA = "page_id long, url string, html string"
ROWS = [(3, "http://a.example/x y", "<p>é</p>"), (1, None, "<p>é</p>"), (2, "http://b.example/é?q=1", None), (5, "", ""),
        (7, "u", "WARC/1.0\r\n\r\nfiledesc://x 1 2 3 4\n\r\n\r\n"), (9, "v", "\n\n"), (4, "w", prose(40_000)),
        (9, "v", "\n\n"), (None, "n", "<p>é</p>"), (None, "n", "only here"), (10, "x", "HTTP/1.1 200 OK\r\n\r\n")]


def plain(rows, least=0):
    groups = {}
    for k, _, h in rows:
        groups.setdefault((h or "").encode(), []).append(k)
    out = []
    for p, keys in groups.items():
        keys.sort(key=lambda k: (k is None, k))
        digest = base64.b32encode(hashlib.sha1(p).digest()).decode()
        for i, k in enumerate(keys):
            again = i > 0 and len(p) >= least
            out.append((k, len(p), digest, "revisit" if again else "response", keys[0] if again else None))
    return sorted(out, key=str)


def got(df, **kw):
    return sorted((tuple(r)[:5] for r in W.archive_pages(df, **kw).collect()), key=str)


@pytest.mark.parametrize("version,size,least", [("1", 2000, 0), ("2", 2, 0), ("1", 3, 5)])
def test_round_trip(spark, version, size, least):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    for c in ("key", "content", "path", "value", "again", "digest"):
        df = df.withColumn(c, F.lit("clash"))
    assert got(df, version=version, records_per_file=size, min_bytes=least) == plain(ROWS, least)


def test_table_and_empty(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    df = df.union(df.filter("page_id % 3 = 0").withColumn("page_id", F.col("page_id") + 1000))
    assert got(df) == plain([(r["page_id"], r["url"], r["html"]) for r in df.collect()])
    assert got(spark.createDataFrame([], SCHEMA)) == []


def test_files_are_archives(spark):
    path = scratch_path(spark, "arc")
    df = spark.createDataFrame(ROWS, SCHEMA).coalesce(1)
    W.write_arc(df, path, "page_id", "url", "html", "2", 4)
    files = [gzip.decompress(r["content"]) for r in W.read_files(spark, path).collect()]
    assert len(files) == 3 and all(f.startswith(b"filedesc://") for f in files)
    W.convert(spark, path, path + "-warc", records_per_file=4)
    for r in W.read_files(spark, path + "-warc").collect():
        data = gzip.decompress(r["content"])
        records = list(W.warc_records(data))
        assert records[0][0]["WARC-Type"] == "warcinfo" and len(records) <= 5
        with pytest.raises(ValueError):
            list(W.warc_records(data.replace(b"Content-Length: ", b"Content-Length: 1", 1)))
    back = {r["record_id"]: r for r in W.read_warc(spark, path + "-warc").collect()}
    for r in back.values():
        if r["record_type"] == "revisit":
            assert back[r["refers_to_id"]]["record_type"] == "response" and back[r["refers_to_id"]]["payload_digest"] == r["payload_digest"]
        assert r["date"] == "2000-01-01T00:00:00Z"


def test_version_specific_headers():
    for version, n in (("1", 5), ("2", 10)):
        data = W.arc_version_block(version) + W.arc_record(version, "http://a/", "4", b"x\ny") + b"\n"
        (offset, fields, content), = W.arc_records(data)
        assert len(fields) == n and fields["URL"] == "http://a/" and W.split_http(content)[1] == b"x\ny"
    with pytest.raises(ValueError):
        list(W.arc_records(W.arc_version_block("1") + b"http://a/ 0.0.0.0 20000101000000 text/html 200 - - 0 f 3\nabc\n"))
    with pytest.raises(ValueError):
        list(W.arc_records(W.arc_version_block("1") + b"http://a/ 0.0.0.0 20000101000000 text/html 9\nabc\n"))
