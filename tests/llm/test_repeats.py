"""Repeat removal against a table of every window, and its parts."""

import hashlib
import random

import numpy as np
import pytest
from cases import WORDS, empty_docs, odd_docs, odd_rows
from hypothesis import given, settings
from hypothesis import strategies as st

from ridelake.llm import repeats as R


def plain(rows):
    first, out = {}, []
    key = lambda k: (k is None, k)
    for k, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - 49):
            w = b[i:i + 50]
            if w not in first or key(k) < key(first[w]):
                first[w] = k
    for k, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - 49):
            if key(first[b[i:i + 50]]) < key(k):
                gone[i:i + 50] = b"\1" * 50
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(1 for x in bytes(gone).split(b"\0") if x)
        out.append((k, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df, **kw):
    return sorted((tuple(r)[:5] for r in R.remove_repeats(df, **kw).collect()), key=str)


def text(n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n))


def rows_with_repeats(n=60):
    rng, passage = random.Random(4), text(30, 999)
    rows = []
    for i in range(n):
        t = text(rng.randint(5, 80), i)
        if i % 3 == 0:
            t += "é" + passage[rng.randint(0, 40):rng.randint(100, 200)] + text(3, 5000 + i)
        if i % 7 == 1:
            t = rows[rng.randrange(len(rows))][1][5:]
        if i % 11 == 5:
            t = "a" * rng.randint(40, 200) + t + "ab" * 60
        rows.append((i * 3 - 50, t))
    return rows


@pytest.fixture
def small(monkeypatch):
    """Several runs and pieces even for small inputs (in the functions that tests call on the driver)."""
    monkeypatch.setattr(R, "_PIECE", 300)


def test_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(5)
    want = plain([(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()])
    assert got(df) == want and sum(r[2] for r in want) > 1000


@pytest.mark.parametrize("hot", [2000, 3])
def test_repeats_of_all_kinds(spark, monkeypatch, hot):
    monkeypatch.setattr(R, "HOT", hot)
    rows = rows_with_repeats()
    rows += [(7, text(40, 71)), (7, text(40, 72)), (7, text(40, 71)), (8, text(40, 72) + text(40, 71)), (None, text(40, 72)), (None, text(40, 72))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(df) == plain(rows)


def test_odd_rows(spark):
    assert got(odd_docs(spark)) == plain([(r[0], r[1]) for r in odd_rows()])
    assert got(empty_docs(spark)) == []


def test_kept_text(spark):
    rows = [(1, "x" + text(30, 1)), (2, "before é " + text(30, 1) + " after"), (3, None)]
    have = {r["doc_id"]: r for r in R.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), kept_text=True).collect()}
    assert have[2]["kept"].startswith("before é".encode()) and have[2]["kept"].endswith(b"after") and len(have[2]["kept"]) < 20
    assert bytes(have[1]["kept"]).decode() == rows[0][1] and have[3]["kept"] == b""


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"ab" * 30, b"a" * 70, b"xyz", bytes(range(40, 100)), b" the "]), max_size=30).map(b"".join))
def test_anchors_cover_every_window_by_content(data):
    raw = np.frombuffer(data, np.uint8)
    _, place, h, first, last = R.anchors(raw)
    starts = [w for a, b in zip(first.tolist(), last.tolist()) for w in range(a, b + 1)]
    assert starts == list(range(max(0, len(data) - R.WINDOW + 1)))
    seen = {}
    for a, g, s, e in zip(place.tolist(), h.tolist(), first.tolist(), last.tolist()):
        for w in range(s, e + 1):
            assert w <= a <= w + R.WINDOW - R.KMER
            assert seen.setdefault(data[w:w + R.WINDOW], (a - w, g)) == (a - w, g)


def test_pieces_of_a_long_text(small):
    data = (text(300, 3) + "a" * 400).encode()
    _, place, h, first, last = R.anchors(np.frombuffer(data, np.uint8))
    starts = [w for a, b in zip(first.tolist(), last.tolist()) for w in range(a, b + 1)]
    assert starts == list(range(len(data) - R.WINDOW + 1))
    assert (h == R.kmer_hashes(np.frombuffer(data, np.uint8))[place]).all()


def test_anchors_of_many_texts_are_those_of_each(small):
    texts = [t.encode() for _, t in rows_with_repeats()] + [b"", b"x" * 49, b"x" * 50, b""]
    at = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    text, place, h, first, last = R.anchors(np.frombuffer(b"".join(texts), np.uint8), at)
    have = {(t, w, p, g) for t, p, g, s, e in zip(*(x.tolist() for x in (text, place, h, first, last))) for w in range(s, e + 1)}
    want = set()
    for i, t in enumerate(texts):
        _, place, h, first, last = R.anchors(np.frombuffer(t, np.uint8))
        want |= {(i, w, p, g) for p, g, s, e in zip(*(x.tolist() for x in (place, h, first, last))) for w in range(s, e + 1)}
    assert have == want


entries = st.lists(st.lists(st.sampled_from([b"a", b"b", b"ab"]), min_size=1, max_size=12).map(b"".join), max_size=25)


@settings(max_examples=200, deadline=None)
@given(st.lists(entries, min_size=1, max_size=7))
def test_loser_tree(lists):
    runs = [sorted((s, b"l", i, j, j, 1) for j, s in enumerate(ss)) for i, ss in enumerate(lists)]
    for run in runs:
        assert [tuple(e[1:]) for e in R.read_run(R.front_code(run))] == run
    tree = R.LoserTree([R.front_code(r) for r in runs])
    out = [tuple(e) for e in tree]
    assert [e[1] for e in out] == sorted(s for ss in lists for s in ss)
    assert sorted(e[1:] for e in out) == sorted(e for r in runs for e in r)
    for x, y in zip(out, out[1:]):
        n = 0
        while n < min(len(x[1]), len(y[1])) and x[1][n] == y[1][n]:
            n += 1
        assert y[0] == n  # every entry comes with what it shares with the one before


def test_known_prefixes_are_not_compared_again():
    runs = [sorted((b"p" * 60 + bytes([i, j]), b"", 0, 0, 0, 1) for j in range(50)) for i in range(16)]
    tree = R.LoserTree([R.front_code(r) for r in runs])
    n = len(list(tree))
    assert n == 800 and tree.compared < 16 * 64 + 800 * 4 * 3
