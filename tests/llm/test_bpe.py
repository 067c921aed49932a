"""Prefix tables against the tiktoken library."""

import hashlib
import random

import public_tokenizers as P
import tiktoken
from cases import empty_docs, odd_docs
from hypothesis import given, settings
from hypothesis import strategies as st

from ridelake.llm import bpe as B

PATH = P.path(B.VOCABULARY)
CODEC = B.codec_of(PATH)
TIKTOKEN = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=CODEC.ranks, special_tokens={})
RAW = tiktoken.Encoding("raw", pat_str=r"(?s).+", mergeable_ranks=CODEC.ranks, special_tokens={})


def expected(text):
    ids = TIKTOKEN.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_documents(spark):
    for df in (odd_docs(spark), spark.read.parquet("/root/testdata/sf0.01/documents.parquet")):
        texts = sorted((str(r["doc_id"]), *expected(r["text"])) for r in df.select("doc_id", "text").collect())
        got = sorted((str(r[0]), *r[1:]) for r in B.encode_documents(df, PATH, P.PATTERN).collect())
        assert got == texts
    assert B.encode_documents(empty_docs(spark), PATH, P.PATTERN).count() == 0


def test_ids_and_long_texts(spark, monkeypatch):
    text = "it's 12 o'clock  \n\n zusätzlich 漢字 <|endoftext|> " * 5
    df = spark.createDataFrame([(1, text), (2, "aé " * 600_000)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in B.encode_documents(df, PATH, P.PATTERN, ids=True).collect()}
    for i, t in ((1, text), (2, "aé " * 600_000)):
        assert rows[i]["ids"] == TIKTOKEN.encode_ordinary(t)
        assert tuple(rows[i])[1:4] == expected(t)


mixed = st.text(st.sampled_from("aeinorst hld.,01é漢\n"), max_size=60)


@settings(max_examples=200, deadline=None)
@given(mixed)
def test_any_bytes_as_one_piece(text):
    data = text.encode()
    assert CODEC.table(data).ids() == (RAW.encode_ordinary(text) if text else [])
    assert CODEC.decode(CODEC.table(data).ids()) == data


@settings(max_examples=150, deadline=None)
@given(mixed, mixed, st.integers(0, 60), st.integers(0, 60))
def test_append_and_edit(text, new, a, b):
    data, more = text.encode(), new.encode()
    table = CODEC.table(data)
    before = list(table.last)
    table.append(more)
    assert table.ids() == CODEC.table(data + more).ids() and table.last[:len(before)] == before
    start, stop = sorted((min(a, len(data)), min(b, len(data))))
    table = CODEC.table(data)
    table.replace(start, stop, more)
    edited = data[:start] + more + data[stop:]
    assert bytes(table.data) == edited and table.last == CODEC.table(edited).last


def test_an_edit_recomputes_only_its_surroundings():
    rng = random.Random(5)
    data = bytes(rng.choice(b"etaoin shrdlu") for _ in range(4000))
    table = CODEC.table(data)
    done = table.replace(2000, 2010, b"there it was")
    assert table.ids() == CODEC.table(data[:2000] + b"there it was" + data[2010:]).ids()
    assert done < 400
