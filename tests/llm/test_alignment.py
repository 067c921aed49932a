"""Token alignment against a plain version that cuts by decoded bytes alone."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from cases import empty_docs, odd_docs
from hypothesis import given, settings
from hypothesis import strategies as st

from ridelake.llm import alignment as A
from ridelake.llm.queries import REGISTRY

PATHS = public_tokenizers.path(A.TOKENIZER_A), public_tokenizers.path(A.TOKENIZER_B)
T = A.Tokenizers(*PATHS)
TRICKY = ["  hé漢 <s>\x00 ﬁ  x\n🙂", "<|endoftext|></s><unk>", "▁a ▁", "▁", "a" * 300 + "漢" * 200, "🙂🙂🇫🇷 é ‍﻿", " ", "\n\n\t x ",
          "don't 12345 ½", "שלום العربية हिन्दी", "͸͹"]


def plain_groups(text):
    if not text:
        return []
    a = T.a.encode(" " + text, add_special_tokens=False).ids
    b = T.b.encode(text)
    raw = (" " + text).encode()
    if b"".join(T.bytes_a[i] for i in a) != raw or b"".join(T.bytes_b[i] for i in b) != raw:
        return []
    out, at, ends = [], [0, 0], [np.cumsum([len(x[i]) for i in ids]).tolist() for x, ids in ((T.bytes_a, a), (T.bytes_b, b))]
    for cut in sorted(set(ends[0]) & set(ends[1])):
        i, j = ends[0].index(cut) + 1, ends[1].index(cut) + 1
        out.append((a[at[0]:i], b[at[1]:j]))
        at = [i, j]
    return out


def plain(rows):
    cut = [(k, plain_groups(t)) for k, t in rows]
    count = Counter(p for _, gs in cut for p in {(x, y) for a, b in gs for x in a for y in b})
    top = Counter()
    for (x, _), n in count.items():
        top[x] = max(top[x], n)
    out = []
    for k, gs in cut:
        pairs = [(x, y) for a, b in gs for x in a for y in b]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in gs)
        out.append((k, sum(len(a) for a, _ in gs), sum(len(b) for _, b in gs), len(gs), len(pairs), sum(count[p] == top[p[0]] for p in pairs),
                    sum(count[p] for p in pairs), hashlib.sha256(text.encode()).hexdigest() if gs else "", text))
    return sorted(out, key=str), count, top


def found(df):
    return sorted(((r["doc_id"], *[r[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")],
                    *([r["groups"]] if "groups" in df.columns else [])) for r in df.collect()), key=str)


def test_odd_texts_and_pairs(spark):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs(spark).collect()] + [(100 + i, t) for i, t in enumerate(TRICKY)]
    docs = odd_docs(spark).select("doc_id", "text").unionAll(spark.createDataFrame(rows[-len(TRICKY):], "doc_id long, text string"))
    got, pairs = A.align(docs.withColumns({c: docs["doc_id"] for c in ("batch", "at", "_key", "_text", "a", "docs")}), *PATHS, groups=True)
    want, count, top = plain(rows)
    assert found(got) == want and sum(1 for w in want if w[1]) >= 12 and sum(1 for w in want if not w[1]) >= 3
    assert {(r["a"], r["b"]): (r["documents"], r["best"]) for r in pairs.collect()} == {p: (n, n == top[p[0]]) for p, n in count.items()}


def test_small_batches_and_dense_groups(spark, monkeypatch):
    """Batches of a text each, and every group paired by distinct ids: the same result."""
    monkeypatch.setattr(A, "BATCH_BYTES", 1)
    monkeypatch.setattr(A, "CHUNK_BYTES", 1)
    rows = [(i, t) for i, t in enumerate(TRICKY * 2 + ["the cat sat", None, ""])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert found(A.align(docs, *PATHS)[0]) == [w[:-1] for w in plain(rows)[0]]
    _, (a, ea, _), (b, eb, _) = T.encode(["a" * 300 + " of 漢字 " * 20])
    sparse = A.links(a, ea, b, eb)[-1]
    monkeypatch.setattr(A, "DENSE_LINKS", 0)
    dense = A.links(a, ea, b, eb)[-1]
    summed = [Counter() for _ in range(2)]
    for c, (g, x, y, n) in zip(summed, (sparse, dense)):
        for k in zip(*(v.tolist() for v in (g, x, y, n))):
            c[k[:3]] += k[3]
    assert summed[0] == summed[1] and len(summed[0])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(min_size=1, max_size=60), min_size=1, max_size=4))
def test_refined_cuts_are_those_of_the_bytes(texts):
    texts = [t.encode("utf-8", "replace").decode() for t in texts]
    some, *found = T.encode(texts)
    for (ids, ends, n), size in zip(found, (T.size_a, T.size_b)):
        assert ends.tolist() == np.cumsum(size[ids]).tolist() and len(n) == len(some) and n.sum() == len(ids)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab '1.é漢🙂\n\t\u00a0\u2003\x1c▁ "), max_size=30))
def test_units_give_the_tokens_of_the_whole_text(text):
    (counts, got, _, _), = A.Units(T).documents([text])
    gs = plain_groups(text)
    assert got == ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in gs)
    assert counts == [sum(len(a) for a, _ in gs), sum(len(b) for _, b in gs), len(gs), sum(len(a) * len(b) for a, b in gs)]


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(A, "KEPT_UNITS", 12)
    units, texts = A.Units(T), ["the cat sat on the mat"] * 3 + TRICKY + [f"w{i} of the cat é{i}" for i in range(40)]
    for some in (texts[i:i + 4] for i in range(0, len(texts), 4)):
        for text, (counts, got, codes, times) in zip(some, units.documents(some)):
            whole, = A.Units(T).documents([text])
            assert counts == whole[0] and got == whole[1] and codes.tolist() == whole[2].tolist() and times.tolist() == whole[3].tolist()
    assert "the" in units.known and len(units.known) < 40


def test_empty_table(spark):
    got, pairs = A.align(empty_docs(spark), *PATHS)
    assert got.count() == 0 and pairs.count() == 0


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_query_equals_the_plain_version(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert found(REGISTRY["op12_token_alignment"][0](spark, sf)) == [w[:-1] for w in plain(rows)[0]]
