"""Merkle manifest against a plain tree."""

import hashlib
import zlib

import pytest
from cases import empty_docs, odd_docs
from pyspark.sql import functions as F

from ridelake.llm import manifest as M
from ridelake.llm.queries import REGISTRY


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(nodes, fanout):
    """The root and each leaf's siblings, per level, left and right."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, k in enumerate(at):
            low = k - k % fanout
            paths[i].append(("".join(nodes[low:k]), "".join(nodes[k + 1:low + fanout])))
        nodes = [H(*nodes[i:i + fanout]) for i in range(0, len(nodes), fanout)]
        at = [k // fanout for k in at]
    return nodes[0], paths


def plain(rows, fanout=16):
    """Rows (id, group, leaf) as (id, leaf, subroot, root, proof)."""
    groups = {}
    for i, g, leaf in rows:
        groups.setdefault(g, []).append((i is not None, i or 0, leaf))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([leaf for _, _, leaf in sorted(groups[g])], fanout) for g in order}
    root, above = tree([trees[g][0] for g in order], fanout)
    return sorted(
        (((i if some else None), leaf, trees[g][0], root, tuple(path + up)) for g, up in zip(order, above)
         for (some, i, leaf), path in zip(sorted(groups[g]), trees[g][1])), key=str)


def found(df):
    return sorted(((r["i"], r["leaf"], r["subroot"], r["root"], tuple((x["left"], x["right"]) for x in r["proof"])) for r in df.collect()), key=str)


@pytest.mark.parametrize("fanout,local,sizes", [
    (2, 1, {"a": 13, "b": 1, None: 8, "": 2, "é": 5}), (3, 1, {"a": 100}), (16, 1, {"a": 700, "b": 257, "c": 16, "d": 17}),
    (4, 2, {f"s{i}": 1 + i % 9 for i in range(40)} | {"hot": 400}), (16, 3, {"a": 1}), (16, 3, {"a": 1, "b": 1})])
def test_manifest_equals_a_plain_tree(spark, fanout, local, sizes):
    rows = [(k * 7 % 1000, g, H(str(g), str(k))) for g, n in sizes.items() for k in range(n)]
    df = spark.createDataFrame(rows, "i long, g string, h string")
    got = M.manifest(df, "i", "g", F.col("h"), fanout=fanout, local_levels=local)
    assert found(got) == plain(rows, fanout)


def test_odd_rows(spark):
    """Null ids and groups, repeated rows, ties and clashing columns; a tampered leaf does not lead to the root."""
    docs = odd_docs(spark).withColumns({c: F.lit("x") for c in ("leaf", "root", "rank", "block", "_leaf", "_pos", "_group", "proof", "digest")})
    leaf = M.leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), F.col("text"))
    rows = [(r["doc_id"], r["source"], H(*["-" if r[c] is None else f"{len(str(r[c]).encode())}:{r[c]}" for c in (
        "doc_id", "source", "lang", "n_chars", "text")])) for r in docs.collect()]
    got = M.manifest(docs, "doc_id", "source", leaf, fanout=2, local_levels=1).withColumnRenamed("doc_id", "i")
    assert found(got) == plain(rows, 2) and len(rows) == 11
    folded = got.select(M.fold(F.col("leaf"), F.col("proof")).alias("a"), M.fold(F.sha2("leaf", 256), F.col("proof")).alias("b"), "root")
    assert folded.filter("a = root AND b <> root").count() == 11


def test_empty_table(spark):
    assert M.manifest(empty_docs(spark), "doc_id", "source", M.leaf_digest(F.col("text"))).count() == 0


def test_a_group_of_equal_rows_is_spread(spark):
    rows = spark.range(3000).select(F.lit(5).alias("i"), F.lit("hot").alias("g"), F.lit("x").alias("h"))
    placed = M.ordered_places(rows, ["g", "i", "h"], "spread")
    assert placed.groupBy("_part").count().agg(F.max("count")).first()[0] < 1500
    got = M.manifest(rows, "i", "g", F.col("h"), fanout=4, local_levels=2)
    assert found(got) == plain([(5, "hot", "x")] * 3000, 4)


def test_query_tampers_every_fifth_checksum(spark):
    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in REGISTRY["op13_butterfly_manifest"][0](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    for d in docs:
        text, r = d["text"], got[d["doc_id"]]
        changed = zlib.crc32(str(d["doc_id"]).encode()) % 5 == 0 and text is not None and any("A" <= c <= "Z" for c in text)
        assert r["verified"] == (not changed) == (r["folded_root"] == r["root"])
    assert 0 < sum(not r["verified"] for r in got.values()) < len(docs)
