"""Language identification by Bayesian fusion of text, declaration, address and host evidence.

The posterior of language ``l`` for a row is proportional to::

    P(l | host) * P(text | l)^t * P(declared | l)

* ``P(text | l)``: naive Bayes over hashed character trigrams of the whole
  text, tempered so that a text counts as at most ``max_effective`` independent trigrams.
* ``P(declared | l)``: how often rows of language ``l`` declare each language
  (markup ``lang`` attribute or label column), a grouped sum of text posteriors.
* ``P(l | host)``: grouped sums of the text posteriors per host, smoothed
  towards the host's address suffix, and that towards the whole corpus.

The trigram model is fitted on a bounded sample of labelled rows
(``sample_rows``, taken by id hash); every count behind the priors covers all rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import document_chunks, staged, utf8_column

BUCKETS = 1 << 16        # hashed trigram space of the text model
SAMPLE_ROWS = 2_000        # labelled rows per language that the text model is fitted on
MAX_EFFECTIVE = 100.0    # independent trigrams a text counts as, at most
PRIOR_STRENGTH = 20.0    # rows of parent prior mixed into a host's (and a suffix's) own counts
MIN_POSTERIOR = 0.5      # rows below it are rejected
POOLED_SHARE = 0.05      # weight of the model of all languages together in each language's trigram model
UNDETERMINED = "und"
_CHUNK = 1 << 20     # bytes of a text at a time

_LETTER = np.zeros(0x110000, np.uint32)


def _letters() -> np.ndarray:
    """Code point to lower-case letter; every other character to a space (filled once per worker)."""
    if not _LETTER[ord("a")]:
        points = [chr(i) for i in range(0x3000)]
        _LETTER[:] = np.arange(len(_LETTER), dtype=np.uint32)
        _LETTER[:0x3000] = [ord(c.lower()[0]) if c.isalpha() else 32 for c in points]
        _LETTER[0x2000:0x2C00] = 32
    return _LETTER


def trigrams(raw: bytes) -> np.ndarray:
    """Hashed trigrams of UTF-8 text, those touching a letter only."""
    a = _letters()[np.frombuffer(raw.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)]
    if len(a) < 3:
        a = np.concatenate([[32], a, [32]]).astype(np.uint32) if len(a) else np.zeros(0, np.uint32)
    if len(a) < 3:
        return np.zeros(0, np.int64)
    x, y, z = a[:-2], a[1:-1], a[2:]
    h = (x * np.uint32(0x9E3779B1) ^ y * np.uint32(0x85EBCA6B)) * np.uint32(5) ^ z * np.uint32(0xC2B2AE35)
    return ((h ^ (h >> np.uint32(15))) >> np.uint32(3) & np.uint32(BUCKETS - 1)).astype(np.int64)[y != 32]


def pieces(body: np.ndarray, size: int):
    """UTF-8 text in pieces of about ``size`` bytes that overlap by two characters, so that no trigram is cut or met twice."""
    at = 0
    while True:
        end = min(at + size, len(body))
        while end < len(body) and body[end] & 0xC0 == 0x80:
            end -= 1
        yield body[at:end]
        if end == len(body):
            return
        for _ in range(2):
            end -= 1
            while body[end] & 0xC0 == 0x80:
                end -= 1
        at = end


def fit_text_model(df: DataFrame, id_col: str, text_col: str, label_col: str,
                   sample_rows: int = SAMPLE_ROWS) -> tuple[list[str], np.ndarray]:
    """Languages (sorted) and the table of trigram log-probabilities, bucket x language.

    The languages are all labels of the whole table, in lower case. Trigram counts come from
    about ``sample_rows`` rows of each, all of a rarer one (by the hash of id and text; equal
    rows once), counted on the executors; the driver gets at most
    ``BUCKETS`` sums per language. Without labelled rows there are no languages.
    """
    labelled = df.filter(F.col(label_col).isNotNull()).select(
        F.lower(F.col(label_col).cast("string")).alias("_label"), F.col(id_col).cast("string").alias("_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    rows = {r["_label"]: r["n"] for r in labelled.groupBy("_label").agg(F.count("*").alias("n")).collect()}  # a row per language
    if not rows:
        return [], np.zeros((BUCKETS, 0), np.float32)
    parts = 1 << 30  # of which a label's rows are in the sample
    share = F.create_map(*[F.lit(x) for label, n in rows.items() for x in (label, min(parts, -(-parts * sample_rows // n)))])
    sampled = labelled.withColumn("_h", F.xxhash64("_id", "_text")).filter(F.pmod("_h", F.lit(parts)) < share[F.col("_label")])

    def count(batches):
        for pdf in batches:
            for label, texts in pdf.groupby("_label")["_text"]:
                c = np.zeros(BUCKETS, np.int64)
                for t in texts:
                    for piece in pieces(np.frombuffer(t.encode(), np.uint8), _CHUNK):
                        c += np.bincount(trigrams(piece.tobytes()), minlength=BUCKETS)
                k = np.flatnonzero(c)
                yield pd.DataFrame({"label": label, "bucket": k, "n": c[k]})

    sums = (sampled.dropDuplicates(["_label", "_h"]).select("_label", "_text")
            .mapInPandas(count, "label string, bucket long, n long")
            .groupBy("label", "bucket").agg(F.sum("n").alias("n")).toPandas())
    languages = sorted(rows)
    counts = np.zeros((BUCKETS, len(languages)))
    counts[sums["bucket"], [languages.index(x) for x in sums["label"]]] = sums["n"]
    pooled = (counts.sum(axis=1) + 0.5) / (counts.sum() + 0.5 * BUCKETS)
    own = counts / np.maximum(counts.sum(axis=0), 1)
    # every language gives the same share to the pooled model: unseen trigrams favour none, however few rows it has
    return languages, np.log((1 - POOLED_SHARE) * own + POOLED_SHARE * pooled[:, None]).astype(np.float32)


def text_evidence(df: DataFrame, keep: list[str], text_col: str, model: np.ndarray,
                  max_effective: float = MAX_EFFECTIVE) -> DataFrame:
    """``keep`` columns, ``_trigrams`` (their number) and ``_ll``, the tempered log-likelihood per language."""
    import pyarrow as pa
    table = df.sparkSession.sparkContext.broadcast(model)  # BUCKETS x languages, a fixed size

    def score(batches):
        m = table.value
        for batch in batches:
            raw, at = utf8_column(batch.column("_text"))
            ll, n = np.zeros((batch.num_rows, m.shape[1])), np.zeros(batch.num_rows, np.int64)
            for first, last in document_chunks(at, _CHUNK):
                for i in range(first, last):
                    body = raw[at[i]:at[i + 1]]
                    for piece in pieces(body, _CHUNK):
                        g = trigrams(piece.tobytes())
                        ll[i] += np.bincount(g, minlength=BUCKETS).astype(np.float32) @ m if len(g) > 8 * BUCKETS \
                            else m[g].sum(axis=0, dtype=np.float64)
                        n[i] += len(g)
            ll *= np.minimum(1.0, max_effective / np.maximum(n, 1))[:, None]
            columns = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n), pa.array(list(ll), pa.list_(pa.float64()))],
                                             [*keep, "_trigrams", "_ll"])

    source = df.select(*keep, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])
    return source.mapInArrow(score, f"{kinds}, _trigrams long, _ll array<double>")


def _softmax(logs):
    e = F.transform(logs, lambda x: F.exp(x - F.array_max(logs)))
    return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, b: a + b))


def _add(a, b):
    return F.zip_with(a, b, lambda x, y: x + y)


def _sums(of: str, n: int):
    return F.array(*[F.sum(F.col(of)[i]) for i in range(n)])


def identify(df: DataFrame, id_col: str, text_col: str, declared_col: str, host_col: str,
             suffix_col: str | None = None, label_col: str | None = None, sample_rows: int = SAMPLE_ROWS,
             prior_strength: float = PRIOR_STRENGTH, min_posterior: float = MIN_POSTERIOR) -> DataFrame:
    """One row per input row: ``id_col``, ``language``, ``posterior``, ``text_language``, ``n_trigrams``, ``rejected``.

    Rejected are rows without any letter and rows whose best language has a
    posterior under ``min_posterior``. Null or empty text gives no text
    evidence: ``text_language`` is ``und`` and the row is rejected. A null
    declaration, host or suffix gives no evidence of its own (rows without a
    host share the suffix prior). Repeated rows each count and each return.
    Equal posteriors go to the language first in order. Labels and declarations are told apart
    in lower case; every label is a language, however rare. Very long texts are read whole, in pieces. Without any labelled
    row every row is ``und`` and rejected. Other columns are ignored, whatever their names.
    """
    label_col = label_col or declared_col
    languages, model = fit_text_model(df, id_col, text_col, label_col, sample_rows)
    n = len(languages)
    rows = df.select(F.col(id_col).alias("_id"), F.lower(F.col(declared_col).cast("string")).alias("_declared"),
                     F.col(host_col).cast("string").alias("_host"),
                     (F.col(suffix_col).cast("string") if suffix_col else F.lit(None).cast("string")).alias("_suffix"),
                     F.col(text_col).alias("_body"))
    if not n:
        return rows.select(F.col("_id").alias(id_col), F.lit(UNDETERMINED).alias("language"),
                           F.lit(0.0).alias("posterior"), F.lit(UNDETERMINED).alias("text_language"),
                           F.lit(0).cast("long").alias("n_trigrams"), F.lit(True).alias("rejected"))
    names = F.array(*[F.lit(x) for x in languages])
    scored = staged(text_evidence(rows, ["_id", "_declared", "_host", "_suffix"], "_body", model), "language-evidence")
    scored = scored.withColumn("_post", _softmax(F.col("_ll")))
    told = scored.filter("_trigrams > 0")

    # host -> suffix -> corpus: partial sums per task, one row per host after the shuffle
    hosts = staged(told.groupBy("_suffix", "_host").agg(_sums("_post", n).alias("_n")), "language-hosts")
    total = np.array(hosts.agg(_sums("_n", n)).first()[0] or [0.0] * n, float)
    total = np.nan_to_num(total.astype(float))
    corpus = F.array(*[F.lit(float(x)) for x in (total + 1) / (total.sum() + n)])

    def smooth(counts, parent):
        mass = F.aggregate(counts, F.lit(0.0), lambda a, b: a + b)
        return F.zip_with(counts, parent, lambda c, p: (c + prior_strength * p) / (mass + prior_strength))

    suffixes = (hosts.groupBy("_suffix").agg(_sums("_n", n).alias("_sn"))
                .select(F.col("_suffix").alias("_s"), smooth(F.col("_sn"), corpus).alias("_sp")))
    priors = staged(hosts.join(suffixes, F.col("_suffix").eqNullSafe(F.col("_s")), "left")
                    .select(F.col("_s").alias("_ps"), F.col("_host").alias("_ph"),
                            F.when(F.col("_host").isNull(), F.col("_sp"))
                            .otherwise(smooth(F.col("_n"), F.col("_sp"))).alias("_prior")), "language-priors")

    # P(declared | language): a languages x languages table from grouped sums
    known = told.filter(F.col("_declared").isin(languages)).groupBy("_declared").agg(_sums("_post", n).alias("_n"))
    declared = np.ones((n, n))
    for r in known.collect():  # one row per language
        declared[languages.index(r["_declared"])] += np.array(r["_n"])
    declared = np.log(declared / declared.sum(axis=0))
    rule = F.array(*[F.lit(0.0)] * n)
    for i, name in enumerate(languages):
        rule = F.when(F.col("_declared") == name, F.array(*[F.lit(float(x)) for x in declared[i]])).otherwise(rule)

    logs = _add(_add(F.col("_ll"), rule), F.transform(F.coalesce(F.col("_prior"), corpus), lambda p: F.log(p)))
    at = lambda a: F.element_at(names, F.array_position(a, F.array_max(a)).cast("int"))
    fused = (scored.join(priors, F.col("_suffix").eqNullSafe(F.col("_ps")) & F.col("_host").eqNullSafe(F.col("_ph")), "left")
             .withColumn("_fused", _softmax(logs)))
    return fused.select(
        F.col("_id").alias(id_col),
        F.when(F.col("_trigrams") > 0, at(F.col("_fused"))).otherwise(UNDETERMINED).alias("language"),
        F.array_max("_fused").alias("posterior"),
        F.when(F.col("_trigrams") > 0, at(F.col("_ll"))).otherwise(UNDETERMINED).alias("text_language"),
        F.col("_trigrams").alias("n_trigrams"),
        ((F.col("_trigrams") == 0) | (F.array_max("_fused") < min_posterior)).alias("rejected"))


def page_evidence(pages: DataFrame) -> DataFrame:
    """Evidence columns of web pages: visible text, declared ``lang`` attribute, host and address suffix.

    Null html or url gives null evidence; a page without a ``lang`` attribute declares nothing.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    text = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    some = lambda c: F.when(c != "", c)
    host = some(F.lower(F.regexp_extract(F.col("url"), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1)))
    return pages.select(
        F.col("page_id"), text.alias("text"), host.alias("host"), F.substring_index(host, ".", -1).alias("suffix"),
        some(F.lower(F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,3})", 1))).alias("declared"))
