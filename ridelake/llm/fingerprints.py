"""Lempel-Ziv phrase fingerprints of documents.

A text is parsed into dictionary phrases (LZ78: each phrase is the shortest
not yet in the dictionary). The set of phrases is what a compressor would have
learnt from the text; its ``K`` smallest 32-bit hashes are the fingerprint.
The share of common hashes among the ``K`` smallest of two fingerprints
estimates the Jaccard similarity of the phrase sets, near 1 for texts that
compress each other well.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_partitions

K = 128  # hashes kept per fingerprint


class PhraseParser:
    """Incremental LZ78 parse: ``feed`` continues where the last text ended, ``undo`` forgets a fed tail."""

    def __init__(self):
        self.phrases: list[str] = []
        self.known: set[str] = set()
        self.open = ""

    def feed(self, text: str) -> None:
        known, current = self.known, self.open
        learn, keep = known.add, self.phrases.append
        for c in text:
            current += c
            if current not in known:
                learn(current)
                keep(current)
                current = ""
        self.open = current

    def mark(self) -> tuple[int, str]:
        return len(self.phrases), self.open

    def undo(self, mark: tuple[int, str]) -> None:
        self.known.difference_update(self.phrases[mark[0]:])
        del self.phrases[mark[0]:]
        self.open = mark[1]


def _hashes(phrases: list[str]) -> np.ndarray:
    from xxhash import xxh32_intdigest
    return np.fromiter(map(xxh32_intdigest, phrases), np.uint32, len(phrases))


def _smallest(hashes: np.ndarray, k: int) -> np.ndarray:
    return np.unique(hashes)[:k]


def fingerprint(text: str | None, k: int = K) -> np.ndarray:
    """The ``k`` smallest phrase hashes, ascending; none for null or empty text."""
    parser = PhraseParser()
    parser.feed(text or "")
    return _smallest(_hashes(parser.phrases), k)


def likeness(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard similarity of two phrase sets; 1 for two empty ones."""
    union = np.union1d(a, b)[:k]
    if not len(union):
        return 1.0
    return float(len(np.intersect1d(np.intersect1d(a, b, True), union, True)) / len(union))


def as_hex(fp: np.ndarray) -> str:
    return fp.astype(">u4").tobytes().hex()


def with_edit(text: str, tail: str, k: int = K) -> tuple[np.ndarray, np.ndarray, str]:
    """Fingerprints of ``text`` and of it with its last third replaced by the start of ``tail``; the edited text.

    Both texts share their first two thirds, which are parsed and hashed once.
    """
    cut = len(text) // 3
    head, new = text[:len(text) - cut], tail[:cut]
    parser = PhraseParser()
    parser.feed(head)
    at = parser.mark()
    shared = _hashes(parser.phrases)
    parser.feed(new)
    edited = _smallest(np.concatenate([shared, _hashes(parser.phrases[at[0]:])]), k)
    parser.undo(at)
    parser.feed(text[len(text) - cut:])
    own = _smallest(np.concatenate([shared, _hashes(parser.phrases[at[0]:])]), k)
    return own, edited, head + new


def _in_blocks(docs: DataFrame, id_col: str, blocks: int) -> DataFrame:
    """Rows with ``_block`` and ``_copy``: id ranges in which each row's successor is present.

    Ranges come from quantiles of the ids. The first row of a block (in
    descending order) also goes, as a copy, to the block before it, whose last
    row it follows; the very first goes to the very last. The driver sees one id per block.
    """
    cuts = docs.stat.approxQuantile(id_col, [i / blocks for i in range(1, blocks)], 0.2 / blocks) if blocks > 1 else []
    cuts = sorted(set(cuts))
    if len(cuts):
        bucketed = Bucketizer(splits=[-float("inf"), *cuts, float("inf")], inputCol="_key", outputCol="_bucket",
                              handleInvalid="keep").transform(docs.withColumn("_key", F.col(id_col).cast("double")))
        block = F.when(F.col(id_col).isNull(), -1).otherwise(F.col("_bucket").cast("int"))
    else:
        bucketed, block = docs, F.when(F.col(id_col).isNull(), -1).otherwise(0)
    bucketed = bucketed.select(id_col, "_text", block.alias("_block"))
    heads = sorted(((r["_block"], r["top"]) for r in
                    bucketed.groupBy("_block").agg(F.max(id_col).alias("top")).collect()), reverse=True)
    if not heads:
        return bucketed.withColumn("_copy", F.lit(False))
    spark = docs.sparkSession
    to = spark.createDataFrame([(heads[i][1], heads[i - 1][0]) for i in range(len(heads))],
                               f"_top {dict(docs.dtypes)[id_col]}, _to int")
    marked = bucketed.join(F.broadcast(to), bucketed[id_col].eqNullSafe(F.col("_top")), "left")  # one row per block
    places = F.array(F.struct(F.col("_block").alias("b"), F.lit(False).alias("c")))
    places = F.when(F.col("_to").isNull(), places).otherwise(
        F.concat(places, F.array(F.struct(F.col("_to").alias("b"), F.lit(True).alias("c")))))
    return marked.select(id_col, "_text", F.explode(places).alias("_place")).select(
        id_col, "_text", F.col("_place.b").alias("_block"), F.col("_place.c").alias("_copy"))


def compare_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """Fingerprint every text and its edited text, and compare both with each other and with the next document's.

    The next document is the one after in descending id (after the last: the
    first; a single row follows itself). Null text counts as empty; an empty
    text has an empty fingerprint. Rows with equal ids stand in order of their
    text, null ids come last. Repeated rows return once each. Other columns are ignored.
    """
    spark = docs.sparkSession
    n = shuffle_partitions(spark)
    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    placed = (_in_blocks(rows, id_col, 4 * n).repartition(n, "_block")
              .sortWithinPartitions("_block", "_copy", F.col(id_col).desc_nulls_last(), "_text")
              .select(F.col(id_col).cast("string").alias("_id"), "_text", "_block", "_copy"))

    def compare(batches):
        held = waiting = None  # the row before; its finished columns but for the next fingerprint
        out = []

        def finish(row, following):
            """Fingerprint ``row``, and complete the row waiting for it."""
            nonlocal waiting
            if following is None:
                own, done = fingerprint(row[1], k), None
            else:
                own, edited, text = with_edit(row[1], following, k)
                done = (row[0], len(row[1]), hashlib.sha256(text.encode()).hexdigest(), as_hex(own), as_hex(edited),
                        likeness(own, edited, k), own)
            if waiting is not None:
                out.append((*waiting[:-1], likeness(waiting[-1], own, k)))
            waiting = done

        def flush():
            rows = pd.DataFrame(out, columns=["_id", "n_chars", "edited_sha256", "fingerprint",
                                              "edited_fingerprint", "near_edited", "near_next"])
            out.clear()
            return rows

        for pdf in batches:
            for key, text, block, copy in zip(pdf["_id"], pdf["_text"], pdf["_block"], pdf["_copy"], strict=True):
                if held is not None:
                    if block == held[2] and not held[3]:
                        finish(held, text)
                    elif waiting is not None:
                        finish(held, None)
                    if block != held[2]:
                        waiting = None
                held = (key, text, block, copy)
            if len(out) >= 2000:
                yield flush()
        if held is not None and waiting is not None:
            finish(held, None)
        if out:
            yield flush()

    compared = placed.mapInPandas(compare, "_id string, n_chars long, edited_sha256 string, fingerprint string, "
                                           "edited_fingerprint string, near_edited double, near_next double")
    return compared.select(F.col("_id").cast(dict(rows.dtypes)[id_col]).alias(id_col), *compared.columns[1:])
