"""From raw documents to tokens: the corpus operators as stages, each written as Parquet and read by the next.

Every stage but the last returns the columns of ``documents``. Null and empty
texts have no language and leave with the first stage; an empty table passes
through all of them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.llm import bpe, decontaminate, language, near_dup, secret_scan
from ridelake.llm.common import staged, table, without_ids
from ridelake.session import scratch_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; of rows with equal ids, all stay if any has one."""
    found = language.identify(docs, "doc_id", "text", "lang", "source")
    rejected = found.groupBy("doc_id").agg(F.min("rejected").alias("_every")).filter("_every").select("doc_id")
    return without_ids(docs, rejected, name="no-language")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, that with the smallest id."""
    return near_dup.keep_one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not contaminated by the benchmark; of rows with equal ids, none stays if any is."""
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return without_ids(docs, found.filter("contaminated").select("doc_id"), name="contaminated")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; each secret is replaced by its kind in brackets, and ``n_chars`` follows the text."""
    found = secret_scan.scan_versions(docs, scratch_path(spark, "ledger"), ["doc_id"])
    spans = staged(found.filter("spans <> ''").select(F.col("doc_id").alias("_found_id"), F.unhex("blob").alias("_blob"),
                                                      F.col("spans").alias("_spans")).distinct(), "secret-spans")
    same = docs["doc_id"].eqNullSafe(F.col("_found_id")) & (F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)) == F.col("_blob"))
    told = docs.join(spans, same, "left")
    text = F.when(F.col("_spans").isNull(), F.col("text")).otherwise(secret_scan.redacted(F.col("text"), F.col("_spans")))
    size = F.when(F.col("_spans").isNull(), F.col("n_chars")).otherwise(F.length("_clean").cast(docs.schema["n_chars"].dataType))
    return told.withColumn("_clean", text).select(
        *[F.col("_clean").alias(c) if c == "text" else size.alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of the ids and of the decoded bytes per document."""
    return bpe.encode_documents(docs, public_tokenizers.path(bpe.VOCABULARY), public_tokenizers.PATTERN)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("tokens", tokenize),
]

# Character models, sketches, automata and merges are beyond SQL: tests compare run() with a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
