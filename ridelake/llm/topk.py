"""Exact top-k search by inner product with multi-resolution segment statistics.

A vector is cut into segments at several resolutions, coarse to fine, and each
segment kept as its mean and standard deviation. For segments of ``w``
components the squared distance of two vectors is at least
``sum w ((mean_q - mean_c)^2 + (dev_q - dev_c)^2)``, so their inner product, half of both
norms less the distance, is at most ``sum w (mean_q mean_c + dev_q dev_c)``. That is an
inner product of short vectors of statistics: a block of queries against a block of candidates is one
small matrix product per resolution. Pairs whose bound stays below the score that their query
already has ``k`` candidates for are dropped; survivors go to the next resolution and in the end to the exact product.

Queries first meet a bounded number of rows, which gives each a score to beat.
Then queries and candidates are dealt into cells of a bounded number of each, every cell
a task of its own, and each query's best of every cell are merged.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions, staged

K = 5
SEGMENTS = (1, 4, 16)       # resolutions: segments per vector
CELL_ROWS = 1 << 16         # queries and candidates of a cell at most, on average
LEAST_ROWS = 1 << 12        # candidates of a cell at least, while there are more cells than tasks at a time
SAMPLE_ROWS = 1 << 12       # rows that give each query its first score to beat: an accelerator, it changes no result
_QUERIES, _CANDIDATES = 256, 4096   # of one matrix product
_EXACT = float(1 << 53)


def statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Per row the means and deviations of its segments, each times the root of the segment's length."""
    bounds = np.linspace(0, x.shape[1], min(segments, max(x.shape[1], 1)) + 1).astype(int)
    parts = [x[:, a:b] for a, b in zip(bounds[:-1], bounds[1:]) if b > a]
    if not parts:
        return np.zeros((len(x), 0))
    width = np.sqrt([p.shape[1] for p in parts])
    return np.concatenate([np.stack([p.mean(1) for p in parts], 1) * width, np.stack([p.std(1) for p in parts], 1) * width], 1)


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of ``a`` and ``b``, two by two, as exact integers."""
    if not len(a) or np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1] < _EXACT:
        return np.einsum("ij,ij->i", a, b).astype(np.int64)
    out = [sum(int(x) * int(y) for x, y in zip(p.tolist(), q.tolist())) for p, q in zip(a, b)]
    return np.array(out, np.int64)  # OverflowError beyond 64 bits


class Best:
    """The ``k`` highest of each query so far; ``least`` is the score to reach."""

    def __init__(self, k: int, least: np.ndarray):
        self.k, self.least = k, least.copy()
        self.query, self.score, self.ids = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray):
        keep = score >= self.least[query]
        query, score, ids = (np.concatenate([x, y[keep]]) for x, y in ((self.query, query), (self.score, score), (self.ids, ids)))
        order = np.lexsort((ids, -score, query))
        query, score, ids = query[order], score[order], ids[order]
        first = np.searchsorted(query, query)
        place = np.arange(len(query)) - first
        top = place < self.k
        full = place == self.k - 1
        self.least[query[full]] = np.maximum(self.least[query[full]], score[full])
        self.query, self.score, self.ids = query[top], score[top], ids[top]


def search(queries: np.ndarray, query_ids: np.ndarray, least: np.ndarray, candidates: np.ndarray, ids: np.ndarray, k: int = K,
           segments=SEGMENTS, counts: list | None = None) -> Best:
    """The best candidates of each query that score at least ``least``, never one of its own id.

    ``counts``, if given, receives for each product the pairs met and those left after each resolution.
    """
    best = Best(k, least)
    stats = [(statistics(queries, s), statistics(candidates, s)) for s in segments]
    room = 1e-9 * (np.abs(queries).max(initial=0) * np.abs(candidates).max(initial=0) * max(queries.shape[1], 1)) + 1e-9  # of rounding
    small = np.abs(queries).max(initial=0) * np.abs(candidates).max(initial=0) * max(queries.shape[1], 1) < _EXACT
    for c in range(0, len(candidates), _CANDIDATES):
        cs = slice(c, c + _CANDIDATES)
        for q in range(0, len(queries), _QUERIES):
            qs = slice(q, q + _QUERIES)
            alive = query_ids[qs, None] != ids[None, cs]
            seen = [alive.size]
            rows = cols = None
            for a, b in stats:
                wanted = best.least[qs] - room
                if rows is None:
                    alive &= a[qs] @ b[cs].T >= wanted[:, None]
                    left = int(alive.sum())
                    if left * 8 < alive.size:  # few: pair by pair from here on
                        rows, cols = np.nonzero(alive)
                else:
                    keep = np.einsum("ij,ij->i", a[qs][rows], b[cs][cols]) >= wanted[rows]
                    rows, cols = rows[keep], cols[keep]
                    left = len(rows)
                seen.append(left)
            if rows is None and small:
                score = queries[qs] @ candidates[cs].T
                rows, cols = np.nonzero(alive & (score >= best.least[qs, None]))
                found = score[rows, cols].astype(np.int64)
            else:
                if rows is None:
                    rows, cols = np.nonzero(alive)
                found = exact_products(queries[qs][rows], candidates[cs][cols])
            best.add(rows + q, found, ids[cs][cols])
            if counts is not None:
                counts.append(seen)
    return best


_LEAST = -float(1 << 63)


def top_k(vectors: DataFrame, is_query, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, scale: int = 256,
          cell_rows: int = CELL_ROWS, least_rows: int = LEAST_ROWS, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``id_col`` and ``score``: for each query row its ``k`` highest inner products.

    Components become ``floor(scale * x)``. ``is_query`` is a condition on the rows; a query meets every row but those of
    its own id. Ties go to the smaller id. Vectors that are null or hold null or non-finite components, and rows without an id, take no part;
    vectors of another length than the query's are no candidates. Rows that repeat an id and a vector are one query, but each a candidate;
    an id with several vectors is a query for each of them. Fewer than ``k`` candidates give fewer rows; an empty table
    none. A product beyond 64 bits fails. Other columns are ignored, and there is no text to be long.
    """
    import pandas as pd
    spark = vectors.sparkSession
    finite = F.forall(vectors[vector_col], lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) != F.lit(float("inf"))))
    rows = vectors.filter(vectors[vector_col].isNotNull() & finite & vectors[id_col].isNotNull()).select(
        vectors[id_col].cast("long").alias("_id"), is_query.alias("_query"), vectors[vector_col].cast("array<double>").alias("_x"))

    def packed(batches):
        for pdf in batches:
            yield pd.DataFrame({"_id": pdf["_id"], "_query": pdf["_query"], "_n": pdf["_x"].map(len),
                                "_v": [np.floor(scale * np.asarray(v, float)).tobytes() for v in pdf["_x"]]})

    rows = rows.withColumn("_query", F.coalesce("_query", F.lit(False))).mapInPandas(packed, "_id long, _query boolean, _n int, _v binary")
    rows = staged(rows.withColumn("_row", F.monotonically_increasing_id()), "vectors")
    queries = staged(rows.filter("_query").select("_id", "_n", "_v").distinct().withColumn("_q", F.monotonically_increasing_id()), "queries")
    n, m = rows.count(), queries.count()
    groups = max(1, -(-m // cell_rows))
    cells = max(1, -(-n // cell_rows), min(shuffle_partitions(spark), n // least_rows))

    def unpack(pdf, column="_v"):
        flat = np.frombuffer(b"".join(pdf[column]), np.float64)
        return flat.reshape(len(pdf), len(flat) // max(len(pdf), 1))

    # a first score to beat: the k-th best of a bounded number of rows
    sample = rows.orderBy(F.xxhash64("_row"), "_row").limit(sample_rows).select("_id", "_n", "_v").toPandas()  # sample_rows vectors at most
    held = spark.sparkContext.broadcast(sample)

    def first_scores(batches):
        some = held.value
        for pdf in batches:
            least = np.full(len(pdf), _LEAST)
            for length, at in pdf.groupby("_n").indices.items():
                others = some[some["_n"] == length]
                mine = pdf.iloc[at]
                found = search(unpack(mine), mine["_id"].to_numpy(), least[at], unpack(others), others["_id"].to_numpy(), k) if len(others) else None
                if found is not None:
                    least[at] = found.least
            yield pdf.assign(_least=least)

    queries = queries.mapInPandas(first_scores, "_id long, _n int, _v binary, _q long, _least double")
    group = F.pmod(F.xxhash64("_q"), F.lit(groups))
    cell = F.pmod(F.xxhash64("_row"), F.lit(cells))
    dealt_queries = queries.select("*", group.alias("_g"), F.explode(F.expr(f"sequence(0L, {cells - 1}L)")).alias("_c"))
    dealt_rows = rows.select("_id", "_n", "_v", cell.alias("_c"), F.explode(F.expr(f"sequence(0L, {groups - 1}L)")).alias("_g"))

    def work(mine: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        out = []
        for length, at in mine.groupby("_n").indices.items():
            qs, cs = mine.iloc[at], others[others["_n"] == length]
            if len(cs):
                b = search(unpack(qs), qs["_id"].to_numpy(), qs["_least"].to_numpy(), unpack(cs), cs["_id"].to_numpy(), k)
                out.append(pd.DataFrame({"_q": qs["_q"].to_numpy()[b.query], "query_id": qs["_id"].to_numpy()[b.query], "_id": b.ids, "score": b.score}))
        return pd.concat(out) if out else pd.DataFrame({c: np.zeros(0, np.int64) for c in ("_q", "query_id", "_id", "score")})

    found = dealt_queries.groupBy("_g", "_c").cogroup(dealt_rows.groupBy("_g", "_c")).applyInPandas(
        work, "_q long, query_id long, _id long, score long")
    order = Window.partitionBy("_q").orderBy(F.col("score").desc(), "_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", F.col("_id").alias(id_col), "score")
