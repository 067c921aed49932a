"""Suffix automaton against matching every window in plain Python."""

import hashlib
import re

import numpy as np
import pytest
from cases import empty_docs, odd_docs, odd_rows, prose
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ridelake.llm import decontaminate as D

ITEMS = "item_id long, text string"


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain(docs, items, window=13):
    found = {}
    for name, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1)) if w else ():
            found.setdefault(tuple(w[i:i + window]), set()).add(str(name))
    sizes = {len(k) for k in found}
    out = []
    for key, text in docs:
        w, hit, names = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (got := found.get(tuple(w[i:i + n]))) is not None:
                    hit.update(range(i, i + n))
                    names |= got
        out.append((key, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def got(docs, items, **kw):
    cols = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    return sorted((tuple(r) for r in D.find_contamination(docs, items, **kw).select(*cols).collect()), key=str)


def pairs(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def test_words_are_those_of_the_pattern():
    for text in ("Ab 12-é🙂 x\x7fy {Z}", "", " ", "a", "漢字 ÀB\x80c", "__9__"):
        raw = np.frombuffer(text.encode(), np.uint8)
        start, end, h = D.words_of(raw)
        low = text.encode().lower() if text.isascii() else "".join(c.lower() if c.isascii() else c for c in text).encode()
        assert [low[a:b].decode() for a, b in zip(start, end)] == words(text)
        assert h.tolist() == [x for w in words(text) for x in D._text_words(w)]


def test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    want = plain(pairs(docs), [tuple(r) for r in items.select("item_id", "text").collect()])
    assert got(docs, items) == want and sum(r[-1] for r in want) > 3


@pytest.mark.parametrize("block_words", [2_000_000, 30])
def test_odd_rows(spark, block_words):
    rows = [(1, prose(20, 7)), (2, prose(20, 7)), (10, "the of"), (11, None), (12, ""), (13, "..."), (None, "stand"),
            (14, "漢字かな🙂 password"), (15, prose(16, 3)), (15, "and thion ere")]
    items = spark.createDataFrame(rows, ITEMS)
    for c in ("spans", "items", "_text", "n_words"):
        items = items.withColumn(c, F.lit("clash"))
    docs = odd_docs(spark)
    want = plain([(r[0], r[1]) for r in odd_rows()], [("" if n is None else n, t) for n, t in rows])
    assert got(docs, items, block_words=block_words) == want
    assert got(empty_docs(spark), items) == []
    assert not any(r[-1] for r in got(docs, items.limit(0)))


small = st.lists(st.sampled_from("a b c d".split()), max_size=12)


@settings(max_examples=300, deadline=None)
@given(st.lists(small, min_size=1, max_size=5), st.lists(st.sampled_from("a b c d x".split()), max_size=40), st.integers(1, 5))
def test_automaton(items, doc, window):
    ids = {w: i + 1 for i, w in enumerate("abcdx")}
    auto = D.Automaton({str(i): [ids[w] for w in ws] for i, ws in enumerate(items)}, window)
    hits, names = auto.match([ids[w] for w in doc])
    (_, n, hit, k, digest, _), = plain([(0, " ".join(doc))], [(i, " ".join(ws)) for i, ws in enumerate(items)], window)
    assert sum(b - a for a, b in hits) == hit and len(names) == k


def test_cut_text(spark):
    item = prose(15, 11)
    docs = spark.createDataFrame([(1, f"é before, {item.upper()} after 🙂"), (2, "clean")], "doc_id long, text string")
    found = D.find_contamination(docs, spark.createDataFrame([(1, item)], ITEMS)).join(docs, "doc_id")
    cut = {r[0]: r[1] for r in found.select("doc_id", D.without_spans(F.col("text"), F.col("spans"))).collect()}
    assert cut[2] == "clean" and cut[1].startswith("é before, ") and cut[1].endswith(" after 🙂") and len(cut[1]) < 22
