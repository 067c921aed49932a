"""Ingest planning: expected files, what is still missing, summary.

The download itself is a network tool and is not rebuilt; its plan and its
resume test are DataFrame jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contracts as C


def expected_files(years: DataFrame, types=C.VEHICLE_TYPES) -> DataFrame:
    """One row per type × year × month with file name and target path.

    ``years`` has an ``anio`` column. Years of the month table use their
    months; any other year uses months 1 .. current month.
    """
    y = F.col("anio")
    months = None
    for year, ms in C.DOWNLOAD_MONTHS.items():
        arr = F.sequence(F.lit(min(ms)), F.lit(max(ms)))
        months = F.when(y == year, arr) if months is None else months.when(y == year, arr)
    months = months.otherwise(F.sequence(F.lit(1), F.month(F.current_date())))
    prefix = F.create_map(*[x for t in types for x in (F.lit(t), F.lit(C.FILE_PREFIX[t]))])
    df = (years.select(y, F.explode(months).alias("mes"))
               .select("anio", "mes", F.explode(F.array(*[F.lit(t) for t in types])).alias("tipo_vehiculo")))
    archivo = F.format_string("%s_%04d-%02d.parquet", prefix[F.col("tipo_vehiculo")], F.col("anio"), F.col("mes"))
    return df.select("tipo_vehiculo", F.col("anio").cast("int"), F.col("mes").cast("int"),
                     archivo.alias("archivo"),
                     F.concat_ws("/", F.lit("bronze"), F.col("tipo_vehiculo"), F.col("anio").cast("string"),
                                 archivo).alias("destino"))


def existing_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Type, year, month and bytes of the monthly files (or folders of part files) below ``paths``.

    From a listing alone; a file without bytes does not exist for the resume test.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
             .load(paths).select("path", "length"))
    name = F.element_at(F.split(F.substring_index("path", ".parquet", 1), "[/=]"), -1)
    month = F.substring_index(name, "_", -1)
    return (files.select(F.substring_index(name, "_", 1).alias("tipo_vehiculo"), F.substring(month, 1, 4).try_cast("int").alias("anio"),
                         F.substring(month, 6, 2).try_cast("int").alias("mes"), "length")
                 .groupBy("tipo_vehiculo", "anio", "mes").agg(F.sum("length").alias("bytes")).where(F.col("bytes") > 0))


def pending(manifest: DataFrame, existing: DataFrame) -> DataFrame:
    """Files of the manifest with no existing (type, year, month) — resume set."""
    return manifest.join(existing, ["tipo_vehiculo", "anio", "mes"], "left_anti")


# What may become of one file of a download run.
STATUSES = ("ok", "skip", "not_found", "timeout", "error")


def planned_results(manifest: DataFrame, existing: DataFrame) -> DataFrame:
    """Results of a run that finds nothing new to download: files present are skipped, the others not published."""
    j = manifest.join(existing, ["tipo_vehiculo", "anio", "mes"], "left")
    return j.select("archivo", F.when(F.col("bytes").isNotNull(), "skip").otherwise("not_found").alias("estado"),
                    F.lit(None).cast("double").alias("mb"))


def ingest_summary(results: DataFrame) -> DataFrame:
    """Files and MB downloaded per status, every status listed; ``results`` has ``estado`` and ``mb``."""
    every = F.explode(F.array(*[F.lit(x) for x in STATUSES])).alias("estado")
    counts = results.groupBy("estado").agg(F.count(F.lit(1)).alias("archivos"), F.sum("mb").alias("total_mb"))
    return results.sparkSession.range(1).select(every).join(counts, "estado", "left").select(
        "estado", F.coalesce("archivos", F.lit(0)).alias("archivos"), F.coalesce("total_mb", F.lit(0.0)).alias("total_mb"))
