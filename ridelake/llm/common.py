"""Helpers shared by the corpus operators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Let Arrow batches hold some MB of text, not Spark's 64 MB of each row in flight, unless the session says otherwise."""
    if spark.conf.get(_BATCH).rstrip("b") == str(64 << 20):
        spark.conf.set(_BATCH, BATCH_BYTES)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet below the shared checkpoint folder and read back.

    Cuts the lineage with files every executor can read, and leaves the
    reader with measured sizes and no inherited partitioning, so that a later
    join may broadcast a small side or split a skewed one. The shuffle files
    of the write go when it has ended, not when the driver next collects garbage.
    """
    spark = df.sparkSession
    small_batches(spark)
    path = scratch_path(spark, name)
    kept = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, kept)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete the files of staged frames that nothing reads any more."""
    for df in frames:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._staged_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def without_ids(df: DataFrame, ids: DataFrame, id_col: str = "doc_id", name: str = "dropped-ids") -> DataFrame:
    """``df`` without the rows whose id is in ``ids`` (one column; null ids match null).

    The ids are staged, so Spark knows their size and moves the text only
    when they are too many to broadcast.
    """
    ids = staged(ids.select(F.col(ids.columns[0]).alias("_dropped_id")).distinct(), name)
    return df.join(ids, df[id_col].eqNullSafe(ids["_dropped_id"]), "left_anti")


def utf8_column(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of an Arrow string column without nulls, as numpy views."""
    import pyarrow as pa
    if hasattr(column, "combine_chunks"):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def document_chunks(offsets: np.ndarray, most: int):
    """Runs of whole rows ``(first, last)`` of at most ``most`` bytes; a longer row is a run of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1)
        yield first, last
        first = last


def release_memory() -> None:
    """Give back to the system what a task's batches took; the worker process lives on for other tasks."""
    import ctypes

    import pyarrow as pa
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)
