"""Incremental secret scan over a ledger of content-addressed blobs.

Every historical version of a file (a row with a path and a text) is addressed
by the SHA-256 of its text. The ledger holds what each rule version has found
in each blob. A scan adds the pairs of unseen blob and rule version only, and
joins the findings of all blobs back to every path that holds them.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import release_memory, staged

RULE_VERSION = "2"
# The base rules, in the order their kinds are listed.
# (pattern, group whose length counts, least length, a string without which no text matches)
BASE_RULES = {
    "assign": (r"[PpSsTtAa](?i:(?<=p)assw(?:or)?d|(?<=s)ecret|(?<=t)oken|(?<=a)pi_?key)"
               r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 1, 8, ""),
    "access": (r"AKIA[A-Z0-9]+", 0, 16, "AKIA"),
    "hex": (r"[0-9a-f]{32,}", 0, 32, ""),  # the runs of [0-9a-f]+ with 32 characters or more
}
# Further rules of this version; their spans come after the base ones'.
EXTRA_RULES = {
    "pem": (r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*-----END [A-Z ]*PRIVATE KEY-----", 0, 1,
            "-----BEGIN"),
    "forge": (r"\bgh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])", 0, 1, "gh"),
    "jwt": (r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1, "eyJ"),
}
KINDS = [*BASE_RULES, *EXTRA_RULES]
_FOUND = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string"

Rules = dict[str, tuple[str, int, int, str]]


def compiled(rules: Rules) -> list[tuple]:
    # ASCII: upper and lower case of the letters written, and no others
    return [(kind, re.compile(p, re.ASCII), *rest) for kind, (p, *rest) in rules.items()]


def find_spans(text: str, rules: list[tuple]) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` in code points, end exclusive, by start and then kind as listed."""
    found = []
    for order, (kind, pattern, group, least, need) in enumerate(rules):
        if need not in text:
            continue
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                found.append((m.start(), order, kind, m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def joined(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def _read_ledger(spark: SparkSession, path: str, rule_version: str) -> DataFrame:
    schema = f"blob binary, {_FOUND}, rule_version string, batch string"
    try:
        return spark.read.schema(schema).parquet(path).filter(F.col("rule_version") == rule_version)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def scan_versions(versions: DataFrame, ledger: str, path_cols: list[str], text_col: str = "text",
                  rule_version: str = RULE_VERSION, rules: Rules | None = None,
                  on_scan: Callable[[int], None] | None = None) -> DataFrame:
    """Scan what ``ledger`` (a folder) does not know yet; findings of every row of ``versions``.

    Returns ``path_cols`` with ``blob`` (SHA-256, lowercase hex), the counts of
    base spans, ``base_sha256`` and ``spans``. One row per input row: repeated
    rows return as often as they come in; null text is the empty blob, null
    path columns are values of their own. Only ``path_cols`` and ``text_col`` are read.

    Only keys (path and digest) are shuffled to pick the unseen blobs; the text
    moves once, for the holder of each. A scan that fails commits nothing, and
    one that is repeated finds the pairs it has stored.
    """
    spark = versions.sparkSession
    patterns = compiled({**BASE_RULES, **EXTRA_RULES} if rules is None else rules)
    body = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = versions.select(*path_cols, body.alias("_text"))
    holder = F.to_json(F.struct(*[F.col(c).cast("string") for c in path_cols]), {"ignoreNullFields": "false"})
    addressed = rows.select(*path_cols, F.unhex(F.sha2("_text", 256)).alias("blob"), holder.alias("_holder"))

    known = _read_ledger(spark, ledger, rule_version).select("blob")
    unseen = staged(addressed.groupBy("blob").agg(F.min("_holder").alias("_holder"))
                    .join(known, "blob", "left_anti"), "unseen-blobs")
    texts = (rows.select("_text", F.unhex(F.sha2("_text", 256)).alias("_b"), holder.alias("_h"))
             .join(unseen, (F.col("_b") == F.col("blob")) & (F.col("_h") == F.col("_holder")), "left_semi")
             .select(F.col("_b").alias("blob"), "_text"))

    def scan(batches):
        for pdf in batches:
            out = []
            for blob, text in zip(pdf["blob"], pdf["_text"], strict=True):
                spans = find_spans(text, patterns)
                base = [s for s in spans if s[0] in BASE_RULES]
                kinds = [s[0] for s in base]
                out.append((blob, kinds.count("assign"), kinds.count("access"), kinds.count("hex"),
                            hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)))
            yield pd.DataFrame(out, columns=["blob", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])
        release_memory()

    (texts.mapInPandas(scan, f"blob binary, {_FOUND}")
     .withColumns({"rule_version": F.lit(rule_version), "batch": F.lit(uuid.uuid4().hex)})
     .write.mode("append").parquet(ledger))
    if on_scan:
        on_scan(unseen.count())

    # findings of blobs with any span, once each; written, so that a blob with many paths can be split in the join
    nothing = hashlib.sha256(b"").hexdigest()
    names = ["n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    findings = staged(_read_ledger(spark, ledger, rule_version).filter("spans <> ''").groupBy("blob")
                      .agg(*[F.first(c).alias(c) for c in names]), "findings")
    back = addressed.drop("_holder").join(findings, "blob", "left")
    blank = {"base_sha256": nothing, "spans": "", "n_assign": 0, "n_access": 0, "n_hex": 0}
    return back.select(*path_cols, F.lower(F.hex("blob")).alias("blob"),
                       *[F.coalesce(F.col(c), F.lit(blank[c])).alias(c) for c in names])


def redacted(text, spans):
    """``text`` with every span replaced by ``[kind]``; overlapping spans become one, named after the first.

    Both are columns (``spans`` as returned by ``scan_versions``); evaluated in Spark.
    """
    parts = F.transform(F.filter(F.split(spans, ","), lambda s: s != ""), lambda s: F.struct(
        F.split(s, ":")[0].alias("k"), F.split(s, ":")[1].cast("int").alias("s"), F.split(s, ":")[2].cast("int").alias("e")))
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    done = F.aggregate(parts, start, lambda a, p: F.struct(
        F.when(p["s"] < a["at"], a["out"]).otherwise(
            F.concat(a["out"], F.substring(text, a["at"] + 1, p["s"] - a["at"]), F.lit("["), p["k"], F.lit("]"))).alias("out"),
        F.greatest(a["at"], p["e"]).alias("at")))
    return F.when(spans == "", text).otherwise(
        F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text))))
