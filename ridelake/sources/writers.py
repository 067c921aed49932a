"""Sinks: partitioned Parquet writes that are safe to re-run (K1–K5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import SILVER_PARTITIONS
from .silver_table import read_silver, replace_silver  # noqa: F401 - the versioned table, beside the plain writers


def write_partitioned(df: DataFrame, path: str, partition_by: tuple[str, ...] | list[str] = (),
                      whole: bool = False) -> None:
    """K2/K3/K4: one overwriting write.

    ``whole``: ``df`` is the whole table, so partitions that it no longer has
    go too. Otherwise only the partitions present in ``df`` are replaced, so
    re-running a subset leaves the others untouched (Spark commits a task's
    files only when the job succeeds).
    """
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static" if whole else "dynamic")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_silver(silver: DataFrame, path: str) -> None:
    """K1: silver trips by ``tipo_vehiculo/anio/mes``, dynamic overwrite.

    No repartition before the write: bronze splits map to one month each, so
    every task already writes into one or few partition folders, and a
    shuffle by partition key would put a whole month (possibly a third of
    all rows) into a single task.
    """
    write_partitioned(silver, path, SILVER_PARTITIONS)


AUDIT_SCHEMA = ("tipo_vehiculo string, anio int, mes int, filas_entrada long, filas_salida long, "
                "pct_retenido double, run_ts timestamp, run_id string")


def write_audit(audit: DataFrame, path: str, run_id: str) -> None:
    """K5: audit rows of one run, partitioned by ``run_id`` with dynamic overwrite.

    Runs accumulate side by side; re-running the same run (a retried job)
    replaces that run's rows instead of appending a second copy.
    """
    (audit.withColumn("run_ts", F.current_timestamp()).withColumn("run_id", F.lit(run_id))
          .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
          .partitionBy("run_id").parquet(path))


def read_audit(spark, path: str) -> DataFrame:
    """The audit table with its declared schema (``run_id`` stays a string)."""
    return spark.read.schema(AUDIT_SCHEMA).parquet(path)
