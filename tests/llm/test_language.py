"""Language fusion: held-out accuracy, the weight of each evidence, odd rows."""

import pytest
from cases import empty_docs, odd_docs
from pyspark.sql import functions as F

from ridelake.llm import language as L


def identify(df, **kw):
    return L.identify(df, "doc_id", "text", "lang", "source", **kw)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_text_alone_on_held_out_rows(spark, docs):
    some = docs.filter("doc_id % 2 = 0")
    languages, model = L.fit_text_model(some, "doc_id", "text", "lang")
    rest = docs.filter("doc_id % 2 = 1").withColumn("l", F.col("lang"))
    got = L.text_evidence(rest, ["l"], "text", model).collect()
    hits = sum(languages[max(range(len(languages)), key=lambda i: r["_ll"][i])] == r["l"] for r in got)
    assert hits / len(got) > 0.98


def test_declaration_and_host_decide_where_text_says_little(spark, docs):
    base = docs.select("doc_id", "text", "lang", F.concat("lang", F.lit("-host")).alias("source"),
                       F.col("lang").alias("label"))
    model = L.fit_text_model(base, "doc_id", "text", "lang")[1]
    word = next(w for w in "жюяфщ" if all(len(set(row)) == 1 for row in model[L.trigrams(w.encode())].tolist()))
    short = spark.createDataFrame([(10_001, word, None, "fr-host"), (10_002, word, "de", "de-host"), (10_003, word, None, None)],
                                  "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r for r in identify(base.unionByName(short, allowMissingColumns=True), label_col="label").filter("doc_id > 10000").collect()}
    assert got[10_001]["language"] == "fr" and got[10_002]["language"] == "de"
    assert got[10_002]["posterior"] > got[10_003]["posterior"]


def test_clean_documents_are_kept(spark, docs):
    got = identify(docs).collect()
    assert len(got) == docs.count() and not any(r["rejected"] for r in got)


def test_odd_rows(spark, docs):
    odd = odd_docs(spark)
    got = identify(odd.unionByName(docs, allowMissingColumns=True)).filter("doc_id is null or doc_id <= 10").collect()
    got = [r for r in got if r["n_trigrams"] == 0]
    assert got and all(r["rejected"] and r["language"] == "und" for r in got)
    assert {r["doc_id"] for r in got} >= {1, 2, 8}
    assert identify(odd).count() == odd.count()
    assert identify(empty_docs(spark)).count() == 0
    assert identify(odd.withColumn("lang", F.lit(None).cast("string"))).filter("rejected").count() == odd.count()


def test_page_evidence(spark):
    rows = [(1, "https://m.site.example.fr:80/x", '<html class="a" LANG=fr><script>var p="</p>";</script><p>bon jour</p></html>'),
            (2, None, None), (3, "nonsense", "<html><p>x</p>")]
    got = {r["page_id"]: r for r in L.page_evidence(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert (got[1]["declared"], got[1]["host"], got[1]["suffix"], got[1]["text"].split()) == ("fr", "m.site.example.fr", "fr", ["bon", "jour"])
    assert (got[2]["declared"], got[2]["host"], got[2]["text"]) == (None, None, "")
    assert (got[3]["declared"], got[3]["host"]) == (None, None)


def test_pieces_keep_every_trigram():
    import numpy as np
    text = ("ab é漢字 🙂x yz " * 300).encode()
    whole = np.bincount(L.trigrams(text), minlength=L.BUCKETS)
    for size in (9, 64, 1000):
        parts = sum(np.bincount(L.trigrams(p.tobytes()), minlength=L.BUCKETS) for p in L.pieces(np.frombuffer(text, np.uint8), size))
        assert (parts == whole).all()


def test_labels_in_any_case_and_a_rare_language(spark, docs):
    """Labels in upper case give the same result, and a language of three rows among a thousand is one of its own."""
    rare = spark.createDataFrame([(20_000 + i, "жюяфщ щифяю " * 30, "xx", "rare") for i in range(3)], "doc_id long, text string, lang string, source string")
    all_docs = docs.select("doc_id", "text", "lang", "source").unionByName(rare)
    have = {r["doc_id"]: (r["language"], round(r["posterior"], 6)) for r in identify(all_docs, sample_rows=50).collect()}
    upper = {r["doc_id"]: (r["language"], round(r["posterior"], 6)) for r in identify(all_docs.withColumn("lang", F.upper("lang")), sample_rows=50).collect()}
    assert have == upper and all(have[20_000 + i][0] == "xx" for i in range(3))
    assert sum(v[0] == "xx" for v in have.values()) == 3


def test_posterior_equals_a_plain_fusion(spark, docs):
    """The whole fusion computed by loops over the text log-likelihoods."""
    import math
    some = docs.filter("doc_id < 300").select("doc_id", "text", "lang", "source")
    languages, model = L.fit_text_model(some, "doc_id", "text", "lang")
    rows = [r for r in L.text_evidence(some, ["doc_id", "lang", "source"], "text", model).collect() if r["_trigrams"]]

    def softmax(x):
        e = [math.exp(v - max(x)) for v in x]
        return [v / sum(e) for v in e]

    n, post = len(languages), [softmax(r["_ll"]) for r in rows]
    hosts: dict = {}
    for r, p in zip(rows, post):
        hosts[r["source"]] = [a + b for a, b in zip(hosts.get(r["source"], [0.0] * n), p)]
    total = [sum(h[i] for h in hosts.values()) for i in range(n)]
    corpus = [(t + 1) / (sum(total) + n) for t in total]
    smooth = lambda c, parent: [(x + L.PRIOR_STRENGTH * p) / (sum(c) + L.PRIOR_STRENGTH) for x, p in zip(c, parent)]
    suffix = smooth(total, corpus)
    told = [[1.0] * n for _ in range(n)]
    for r, p in zip(rows, post):
        if r["lang"] in languages:
            told[languages.index(r["lang"])] = [a + b for a, b in zip(told[languages.index(r["lang"])], p)]
    got = {r["doc_id"]: r for r in identify(some).collect()}
    for r in rows:
        prior = suffix if r["source"] is None else smooth(hosts[r["source"]], suffix)
        logs = [v + math.log(q) for v, q in zip(r["_ll"], prior)]
        if r["lang"] in languages:
            d = told[languages.index(r["lang"])]
            logs = [v + math.log(d[i] / sum(row[i] for row in told)) for i, v in enumerate(logs)]
        want = softmax(logs)
        assert abs(got[r["doc_id"]]["posterior"] - max(want)) < 1e-6
        assert got[r["doc_id"]]["language"] == languages[want.index(max(want))]
