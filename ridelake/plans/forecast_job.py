"""Forecast export job (ML5 + K4 + A18)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import forecast as FC
from ..sources import writers as WR


def run(series: DataFrame, path: str, exclude: DataFrame | None = None) -> DataFrame:
    """Forecast every series and write it partitioned by type (dynamic overwrite).

    Re-running replaces each series' partition instead of appending a copy.
    """
    fc = FC.demand_forecast(series, exclude=exclude)
    WR.write_partitioned(fc, path, ("tipo_vehiculo",))
    return series.sparkSession.read.parquet(path)


def row_counts(forecast: DataFrame) -> DataFrame:
    """History and forecast row counts per series."""
    fut = F.col("es_prediccion")
    return forecast.groupBy("tipo_vehiculo").agg(
        F.sum(F.when(~fut, 1).otherwise(0)).cast("long").alias("filas_historicas"),
        F.sum(F.when(fut, 1).otherwise(0)).cast("long").alias("filas_prediccion"))


def last_rows(forecast: DataFrame, k: int = 5) -> DataFrame:
    """The last ``k`` days of each series' forecast (a per-series top-k)."""
    w = Window.partitionBy("tipo_vehiculo").orderBy(F.col("fecha").desc())
    return forecast.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn")
