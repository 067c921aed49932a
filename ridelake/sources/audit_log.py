"""Audit log as CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AUDIT_CSV_SCHEMA = ("tipo_vehiculo string, anio int, mes int, filas_entrada long, filas_salida long, "
                    "pct_retenido double, run_ts timestamp, run_id string")


def write_audit_csv(audit: DataFrame, path: str, run_id: str) -> None:
    """One run's rows of a headered CSV log, in the run's own folder: a retried run replaces its rows."""
    audit.select("tipo_vehiculo", "anio", "mes", "filas_entrada", "filas_salida", "pct_retenido",
                 F.current_timestamp().alias("run_ts"), F.lit(run_id).alias("run_id")) \
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("header", "true") \
         .partitionBy("run_id").csv(path)


def read_audit_csv(spark: SparkSession, path: str, types: tuple[str, ...] | None = None) -> DataFrame:
    """Read the CSV log with a declared schema, optionally keeping some types."""
    df = spark.read.option("header", "true").schema(AUDIT_CSV_SCHEMA).csv(path)
    return df.where(F.col("tipo_vehiculo").isin(*types)) if types else df
