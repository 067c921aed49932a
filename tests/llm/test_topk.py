"""Top-k search against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridelake.llm import topk as K

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, k=5, every=50):
    ok = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out, done = [], set()
    for i, v in ok:
        if i % every == 0 and (i, tuple(v)) not in done:
            done.add((i, tuple(v)))
            scored = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in ok if j != i and len(w) == len(v))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def found(df):
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.select("query_id", "rank", "vec_id", "score").collect())


def frame(spark, rows):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    return df.withColumns({c: F.lit("clash") for c in ("_id", "_v", "rank", "score", "query_id", "_q", "_row")})


def rows_of(kind, n=600, d=24, seed=3):
    rng = np.random.default_rng(seed)
    x = {"normal": rng.normal(0, 0.2, (n, d)), "level": rng.normal(0, 0.05, (n, d)) + rng.normal(0, 1, (n, 1)),
         "ties": rng.integers(0, 2, (n, d)) / 256, "equal": np.ones((n, d)) / 4}[kind].astype(np.float32)
    return [(i, v.tolist()) for i, v in enumerate(x)]


@pytest.mark.parametrize("kind", ["normal", "level", "ties", "equal"])
def test_equals_brute_force_in_many_cells(spark, kind):
    rows = rows_of(kind)
    got = K.top_k(frame(spark, rows), F.col("vec_id") % 10 == 0, cell_rows=25, least_rows=50, sample_rows=30)
    assert found(got) == plain(rows, every=10)
    assert found(K.top_k(frame(spark, rows), F.col("vec_id") % 50 == 0)) == plain(rows)


def test_odd_rows(spark):
    """Nulls, non-finite components, other lengths, empty vectors, repeated rows and ids, too few candidates, large values."""
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [0.5, -2.0]), (50, None), (100, [nan, 1.0]), (1, [inf, 1.0]), (2, [None, 1.0]), (3, [1.0, 1.0]),
            (3, [1.0, 1.0]), (4, [1.0, 1.0]), (150, [1.0, 2.0, 3.0]), (5, [0.1, 0.2, 0.3]), (200, []), (6, []), (None, [1.0, 1.0]),
            (250, [3.0e6, 2.9e6, 1.0, 1.0]), (7, [1.3e6, 1.1e6, 5.0, -7.0]), (8, [1.3e6, 1.1e6, 5.0, -6.9]), (300, [1.0] * 5)]
    assert found(K.top_k(frame(spark, rows), F.col("vec_id") % 50 == 0)) == plain(rows)
    assert K.top_k(frame(spark, rows[3:5]), F.col("vec_id") % 50 == 0).count() == 0
    assert K.top_k(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 50 == 0).count() == 0


def test_bounds_hold_and_drop_pairs():
    rng = np.random.default_rng(5)
    x = np.floor(256 * (rng.normal(0, 0.02, (3000, 64)) + np.repeat(rng.normal(0, 1, (3000, 16)), 4, 1)))
    for s in K.SEGMENTS:
        a = K.statistics(x[:100], s)
        b = K.statistics(x, s)
        assert (a @ b.T >= x[:100] @ x.T - 1e-3).all()
    counts: list = []
    least = K.search(x[:50], np.arange(50), np.full(50, -1e18), x[:500], np.arange(500)).least
    found = K.search(x[:50], np.arange(50), least, x, np.arange(3000), counts=counts)
    met = np.array(counts).sum(0)
    assert (np.diff(met) <= 0).all() and met[-1] < met[0] * 0.05  # vectors that are level within segments: few pairs reach the exact product
    want = np.sort(np.where(np.eye(50, 3000), -1e18, x[:50] @ x.T), 1)[:, -5:]
    assert all(sorted(found.score[found.query == i]) == want[i].tolist() for i in range(50))
