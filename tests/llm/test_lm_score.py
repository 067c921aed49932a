"""Masked pseudo-likelihood: gradients, sums against a plain loop, held-out quality, odd rows."""

import numpy as np
import pandas as pd
import pytest
from cases import empty_docs, odd_docs, odd_rows
from pyspark.sql import functions as F

from ridelake.llm import lm_score as L


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(1)
    p = {k: v.astype(np.float64) for k, v in L.initial().items()}
    context, target = rng.integers(0, 1 << 24, 50), rng.integers(1, 64, 50)
    w = rng.integers(1, 9, 50).astype(float)

    def loss():
        return -(L.log_probabilities(p, context)[np.arange(50), target] * w).sum() / w.sum()

    g = L.gradient(p, context, target, w)
    for k in p:
        for i in map(tuple, np.argwhere(np.abs(g[k]) > np.abs(g[k]).max() / 2)[:3]):
            old, e = p[k][i], 1e-5
            p[k][i] = old + e
            up = loss()
            p[k][i] = old - e
            down = loss()
            p[k][i] = old
            assert (up - down) / (2 * e) == pytest.approx(g[k][i], rel=1e-3)


def plain(text, p, classes, within):
    a = [0, 0, *(int(classes[ord(c)]) for c in text), 0, 0]
    total = 0.0
    for i, c in enumerate(text):
        code = 0
        for d in (0, 1, 3, 4):
            code = code << 6 | a[i + d]
        total += float(L.log_probabilities(p, np.array([code]))[0, a[i + 2]]) + float(within[ord(c)])
    return total


def test_scores_equal_a_plain_loop(spark, monkeypatch):
    counts = pd.DataFrame([(ord(c), 1000 - i) for i, c in enumerate("etaoin shrdlu.,é")], columns=["point", "n"])
    counts = pd.concat([counts, pd.DataFrame([(500 + i, 60 - i) for i in range(60)], columns=["point", "n"])], ignore_index=True)
    classes, within = L.character_classes(counts)
    p = L.initial(3)
    texts = ["", "e", "tea", "the seashore. é", "漢 ǵ tea " * 9, "\x00"]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "_key string, _text string").coalesce(1)
    got = {r["_key"]: r for r in L.score(df, p, classes, within).collect()}
    for i, t in enumerate(texts):
        assert got[str(i)]["n_tokens"] == len(t)
        assert got[str(i)]["log_prob"] == pytest.approx(plain(t, p, classes, within), rel=1e-4, abs=1e-4)


def test_held_out_documents_beat_character_frequencies(docs):
    learn, held = docs.filter("doc_id % 4 > 0 and lang = 'en'"), docs.filter("doc_id % 4 = 0 and lang = 'en'")
    got = L.pseudo_likelihood(held, corpus=learn).agg(F.sum("log_prob"), F.sum("n_tokens")).first()
    c = L.character_counts(held.withColumn("_text", F.col("text")))["n"].to_numpy()
    unigram = float((c * np.log(c / c.sum())).sum())
    assert got[0] > 0.6 * unigram  # negative: at least two fifths less surprise than the held-out text's own frequencies


def test_shuffled_text_scores_lower(spark, docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.filter("doc_id < 60").collect()]
    rng = np.random.default_rng(2)
    mixed = [(1000 + i, "".join(rng.permutation(list(t)))) for i, t in rows]
    got = {r["doc_id"]: r["mean_log_prob"] for r in L.pseudo_likelihood(
        spark.createDataFrame(rows + mixed, "doc_id long, text string"), corpus=docs).collect()}
    assert sum(got[i] > got[1000 + i] for i, _ in rows) > 0.95 * len(rows)


def test_odd_rows(spark):
    got = sorted((str(r["doc_id"]), r["n_tokens"]) for r in L.pseudo_likelihood(odd_docs(spark), rounds=1).collect())
    assert got == sorted((str(r[0]), len(r[1] or "")) for r in odd_rows())
    assert all((r["mean_log_prob"] is None) == (r["n_tokens"] == 0) for r in L.pseudo_likelihood(odd_docs(spark), rounds=1).collect())
    assert L.pseudo_likelihood(empty_docs(spark)).count() == 0


def test_window_counts(spark):
    texts = ["abcab", "", "a", "bca"]
    df = spark.createDataFrame([(t,) for t in texts], "_text string").repartition(2)
    classes = np.full(0x110000, 63, np.uint8)
    classes[[97, 98, 99]] = 1, 2, 3
    want = {}
    for t in texts:
        a = [0, 0, *(classes[ord(c)] for c in t), 0, 0]
        for i in range(len(t)):
            code = 0
            for d in (0, 1, 3, 4, 2):
                code = code << 6 | int(a[i + d])
            want[code] = want.get(code, 0) + 1
    assert {r["code"]: r["n"] for r in L.window_counts(df, classes).collect()} == want


def rare_model(letters="abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"):
    counts = pd.DataFrame([(ord(c), 9000 - i) for i, c in enumerate(letters)] + [(0x430 + i, 90 - i) for i in range(32)], columns=["point", "n"])
    classes, within = L.character_classes(counts)
    return classes, within, L.Rare(counts, classes)


def test_gradient_with_rare_characters():
    classes, _, rare = rare_model()
    rng = np.random.default_rng(5)
    p = {k: (v + 0.3 * rng.standard_normal(v.shape)).astype(np.float64) for k, v in L.initial(rare=rare).items()}
    ranks = rng.integers(0, rare.size + 1, (60, 5)) * rng.integers(0, 2, (60, 5))
    places = np.where(ranks > 0, 63, rng.integers(1, 63, (60, 5)))
    context, target = (places[:, :4] << np.array([18, 12, 6, 0])).sum(axis=1), places[:, 4]
    w = rng.integers(1, 9, 60).astype(float)
    loss = lambda: -(L.rare_log_probabilities(p, context, target, ranks, rare) * w).sum() / w.sum()
    g = L.gradient(p, context, target, w, ranks, rare)
    for k in p:
        for i in map(tuple, np.argwhere(np.abs(g[k]) > np.abs(g[k]).max() / 2)[:3]):
            old, e = p[k][i], 1e-5
            p[k][i] = old + e
            up = loss()
            p[k][i] = old - e
            down = loss()
            p[k][i] = old
            assert (up - down) / (2 * e) == pytest.approx(g[k][i], rel=1e-3)


def test_probabilities_of_all_characters_add_up_to_one():
    classes, _, rare = rare_model()
    p = {k: v + np.float32(0.2) * np.random.default_rng(1).standard_normal(v.shape).astype(np.float32)
         for k, v in L.initial(rare=rare).items()}
    points = [*range(48, 58), *range(65, 91), *range(97, 123), *range(0x430, 0x450), 0x4E00]  # the last: never counted
    target, own = classes[points].astype(np.int64), rare.ranks[points]
    ranks = np.zeros((len(points), 5), np.int64)
    ranks[:, 0], ranks[:, 4] = rare.ranks[0x433], own
    context = np.full(len(points), (63 << 18) + (5 << 12) + (6 << 6) + 7)
    boundary = np.exp(L.rare_log_probabilities(p, context[:1], np.zeros(1, np.int64), ranks[:1] * [1, 1, 1, 1, 0], rare))[0]
    assert np.exp(L.rare_log_probabilities(p, context, target, ranks, rare)).sum() + boundary == pytest.approx(1, abs=1e-4)


def test_letters_of_a_rare_script_are_predicted_from_their_neighbours(spark, docs):
    rng = np.random.default_rng(8)
    lexicon = ["время", "город", "книга", "дорога",
               "слово", "письмо", "утро", "река"]
    said = [[lexicon[i] for i in rng.integers(0, 8, 60)] for _ in range(60)]
    mixed = [["".join(rng.permutation(list(w))) for w in t] for t in said[:20]]
    latin = [(10_000 + i, r["text"]) for i, r in enumerate(docs.filter("lang = 'en'").limit(300).collect())]
    corpus = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(said)] + latin, "doc_id long, text string").coalesce(2)
    held = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(said[:20])] + [(100 + i, " ".join(t)) for i, t in enumerate(mixed)],
                                 "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: r["mean_log_prob"] for r in L.pseudo_likelihood(held, corpus=corpus).collect()}
    assert all(got[i] > got[100 + i] + 0.5 for i in range(20))
