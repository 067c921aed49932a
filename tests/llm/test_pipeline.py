"""The pipeline against a plain version of its stages."""

import hashlib

import corpus_pipeline as P
import public_tokenizers
import pytest
import test_decontaminate
import test_near_dup
import test_secrets
import tiktoken
from cases import odd_docs
from pyspark.sql import functions as F

from ridelake.llm import bpe, secret_scan


def test_stages_are_those_asked_for():
    assert [n for n, _ in P.STAGES] == ["language", "near_duplicates", "decontamination", "secrets", "tokens"]


def redact(text):
    out, at = "", 0
    for kind, s, e in secret_scan.find_spans(text, secret_scan.compiled({**secret_scan.BASE_RULES, **secret_scan.EXTRA_RULES})):
        if s >= at:
            out += text[at:s] + f"[{kind}]"
        at = max(at, e)
    return out + text[at:]


def test_run_equals_a_plain_version(spark, tmp_path):
    d = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{d}/benchmark.parquet").collect()]
    rows = [(k, t) for k, t in rows if any(c.isalpha() for c in t or "")]
    first = {k: c for k, c, _ in test_near_dup.plain_classes(rows)}
    rows = [(k, t) for k, t in rows if first[k] == k]
    dirty = {r[0] for r in test_decontaminate.plain(rows, items) if r[-1]}
    assert dirty
    rows = [(k, redact(t)) for k, t in rows if k not in dirty]
    ranks = bpe.load_ranks(public_tokenizers.path(bpe.VOCABULARY))
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for k, t in rows:
        ids = lib.encode_ordinary(t)
        want.append((k, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    assert sorted(map(tuple, P.run(spark, d).collect())) == sorted(want)


@pytest.mark.parametrize("stage", P.STAGES[:-1], ids=[n for n, _ in P.STAGES[:-1]])
def test_stages_return_the_columns_of_documents(spark, stage):
    d = "/root/testdata/sf0.001"
    docs = odd_docs(spark)
    left = stage[1](spark, docs, d)
    assert left.columns == docs.columns and left.dtypes == docs.dtypes
    ids = [r["doc_id"] for r in left.collect()]
    assert {4, 6, 9} <= set(ids) and None in ids or stage[0] == "near_duplicates"
    assert stage[1](spark, docs.limit(0), d).count() == 0


def test_secrets_are_redacted(spark):
    docs = odd_docs(spark)
    left = {r["doc_id"]: r for r in P.redact_secrets(spark, docs, "").collect()}
    assert left[9]["text"] == "漢字かな🙂 [assign]\x00x" and left[9]["n_chars"] == len(left[9]["text"])
    assert left[1]["text"] is None and left[2]["text"] == "" and left[5]["n_chars"] == 0
    assert P.redact_secrets(spark, docs, "").filter(F.col("doc_id") == 5).count() == 2
