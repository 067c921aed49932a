"""Secret ledger: spans against plain matching, incremental scans, every path of a blob."""

import hashlib
import re

from cases import empty_docs, odd_docs, odd_rows, prose
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ridelake.llm import secret_scan as S
from ridelake.session import scratch_path

BASE = S.compiled(S.BASE_RULES)


def plain(text):
    out = []
    word = "(?:" + "|".join("".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in w)
                            for w in ("password", "passwd", "secret", "token", "api_key", "apikey")) + ")"
    for m in re.finditer(f"({word})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, "assign", m.end()))
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(k, s, e) for s, _, k, e in sorted(out)]


piece = st.sampled_from(["password", "PassWD", "secret", "TOKEN", "api_key", "ApiKey", "'", '"', " ", "=", ":", "abcdefgh", "a1+/_.=-",
                         "AKIA", "ABCDEF012345", "AKIAX", "0123456789abcdef", "deadbeef" * 4, "é", "\n", "🙂", "K", "toKen"])


@settings(max_examples=400, deadline=None)
@given(st.lists(piece, max_size=14).map("".join))
def test_base_spans_equal_plain_matching(text):
    assert S.find_spans(text, BASE) == plain(text)
    every = S.find_spans(text, S.compiled({**S.BASE_RULES, **S.EXTRA_RULES}))
    assert [s for s in every if s[0] in S.BASE_RULES] == plain(text)


def scan(df, ledger, **kw):
    seen = []
    rows = S.scan_versions(df, ledger, ["doc_id"], on_scan=seen.append, **kw).collect()
    return rows, seen[0]


def test_odd_rows_and_table(spark):
    for df in (odd_docs(spark), spark.read.parquet("/root/testdata/sf0.01/documents.parquet")):
        texts = [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]
        rows, scanned = scan(df, scratch_path(spark, "ledger"))
        assert scanned == len({t for _, t in texts})
        want = sorted((str(i), hashlib.sha256(t.encode()).hexdigest(), S.joined(plain(t))) for i, t in texts)
        have = sorted((str(r["doc_id"]), r["blob"], S.joined([s for s in ((a.split(":")[0], *map(int, a.split(":")[1:]))
                      for a in r["spans"].split(",") if a) if s[0] in S.BASE_RULES])) for r in rows)
        assert have == want
        for r in rows:
            n = [sum(k == x for k in (a.split(":")[0] for a in r["spans"].split(","))) for x in S.BASE_RULES]
            assert n == [r["n_assign"], r["n_access"], r["n_hex"]]
    assert scan(empty_docs(spark), scratch_path(spark, "ledger"))[0] == []


def test_only_unseen_pairs_are_scanned(spark):
    ledger, secret = scratch_path(spark, "ledger"), "token=abcdefgh99 "
    first = spark.createDataFrame([(1, secret + "x"), (2, secret + "x"), (3, "clean")], "doc_id long, text string")
    rows, scanned = scan(first, ledger)
    assert scanned == 2 and sum(r["n_assign"] for r in rows) == 2
    later = first.union(spark.createDataFrame([(1, "clean"), (4, secret + "y")], first.schema))
    rows, scanned = scan(later, ledger)
    assert scanned == 1 and sorted((r["doc_id"], r["n_assign"]) for r in rows) == [(1, 0), (1, 1), (2, 1), (3, 0), (4, 1)]
    assert scan(later, ledger)[1] == 0
    assert scan(later, ledger, rule_version="3")[1] == 3  # another rule version sees all blobs anew


def test_redaction(spark):
    text = "é password=abcdefgh12 and " + "0a" * 20 + " end"
    df = S.scan_versions(spark.createDataFrame([(1, text), (2, "fine")], "doc_id long, text string"),
                         scratch_path(spark, "ledger"), ["doc_id"])
    got = {r[0]: r[1] for r in df.select("doc_id", S.redacted(F.when(F.col("doc_id") == 1, F.lit(text)).otherwise("fine"),
                                                              F.col("spans"))).collect()}
    assert got == {1: "é [assign] and [hex] end", 2: "fine"}


def test_one_blob_under_many_paths(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("token: zzzzzzzz9 "),
                                  F.lit(prose(20)))).otherwise(F.concat(F.lit("v"), F.col("id"))).alias("text"))
    rows, scanned = scan(df, scratch_path(spark, "ledger"))
    assert scanned == 1001 and sum(r["n_assign"] for r in rows) == 2000 and len(rows) == 3000
