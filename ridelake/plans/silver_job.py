"""Batch bronze → silver job (F6 + K1 + A10/K5) over every bronze file at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import SILVER_PARTITIONS
from ..operators import conform as CF
from ..operators import silver as SV
from ..sources import bronze as BR
from ..sources import silver_table as ST
from ..sources import writers as WR


def conformed_bronze(spark: SparkSession, folders: dict[str, str]) -> DataFrame:
    """All types, all months: one scan per type folder, conformed and unioned."""
    raws = BR.read_bronze_types(spark, folders)
    return CF.conform_all(raws, keep=BR.FILE_COLUMNS)


def run(spark: SparkSession, folders: dict[str, str], silver_path: str, audit_path: str, run_id: str) -> DataFrame:
    """Replace every month that the run reads in silver, and write the audit of this run (its own partition).

    The write is the only pass over the data, and readers see all of its months
    change at once. The audit is computed from row counts afterwards: rows in
    per bronze file and rows out per month folder of the version written
    both come from Parquet footers and paths, so no data column is
    read a second time (bronze is never persisted either, which at 100 TB
    would cost more than the data pass itself).
    """
    bronze = conformed_bronze(spark, folders)
    version = ST.replace_silver(SV.clean(bronze), silver_path, BR.file_months(spark, folders))
    rows_out = ST.read_version(spark, silver_path, version).select(*SILVER_PARTITIONS)
    audit = SV.audit_of_counts(BR.rows_per_month(spark, folders), rows_out)
    WR.write_audit(audit, audit_path, run_id)
    return WR.read_audit(spark, audit_path).where(F.col("run_id") == run_id)
