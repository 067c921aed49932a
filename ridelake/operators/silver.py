"""Bronze → silver: clean, enrich and count in one plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import SILVER_COLUMNS
from ..functions.numeric import count_if
from ..functions.time import duration_minutes
from .rules import file_month_rule, type_rule, verdict


def derive_columns(df: DataFrame, year: Column | str = "file_anio", month: Column | str = "file_mes") -> DataFrame:
    """Duration, pickup hour and weekday, and the *file's* year/month."""
    y = F.col(year) if isinstance(year, str) else year
    m = F.col(month) if isinstance(month, str) else month
    return df.withColumns({
        "duracion_min": duration_minutes(),
        "hora": F.hour("pickup_datetime"),
        "dia_semana": F.dayofweek("pickup_datetime"),
        "mes": m.cast("int"),
        "anio": y.cast("int"),
    })


def clean(bronze: DataFrame, tipo: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """conformed bronze rows (with ``file_ym``) → silver rows.

    One filter on the per-type rule and the file-month rule, then the
    derived columns; output is the 21 silver columns (+ ``keep``). The
    filter is the bare conjunction (a NULL verdict drops the row just as
    false does): over a union of per-type scans the type CASE folds to one
    rule per branch and its plain comparisons reach the Parquet scan as
    pushed filters. Past the month rule the file's month is the pickup's, which
    is what the derived columns then use: the path is read by the rule alone.
    """
    p = F.col("pickup_datetime")
    out = derive_columns(bronze.where(type_rule(tipo) & file_month_rule()), F.year(p), F.month(p))
    return out.select(*keep, *SILVER_COLUMNS)


def _retained_pct(rows_in: Column, rows_out: Column) -> Column:
    """Retained share in percent, 2 decimals half-up; 0 when nothing came in."""
    return F.when(rows_in > 0, (F.lit(100.0) * rows_out / rows_in)
                  .cast("decimal(38,6)").cast("decimal(38,2)").cast("double")).otherwise(F.lit(0.0))


def audit(bronze: DataFrame, tipo: str | None = None) -> DataFrame:
    """A10: rows in / rows out per type × file month, retained % (0 when empty).

    One aggregation over the same scan the write uses: the verdict is a
    boolean column, counted instead of filtered.
    """
    ok = verdict(tipo)
    agg = (bronze.groupBy("tipo_vehiculo", F.col("file_anio").alias("anio"), F.col("file_mes").alias("mes"))
                 .agg(F.count(F.lit(1)).alias("filas_entrada"), count_if(ok).alias("filas_salida")))
    return agg.withColumn("pct_retenido", _retained_pct(F.col("filas_entrada"), F.col("filas_salida")))


def audit_of_counts(rows_in: DataFrame, written: DataFrame) -> DataFrame:
    """A10 after a silver write, from row counts alone: ``filas_entrada`` per type × file month, and the rows written.

    Rows out are counted per silver partition, which needs only Parquet footers
    and partition paths. A month with no surviving rows has no partition and gets 0.
    """
    keys = ["tipo_vehiculo", "anio", "mes"]
    rows_out = written.groupBy(*keys).agg(F.count(F.lit(1)).alias("filas_salida"))
    j = rows_in.join(rows_out, keys, "left").withColumn("filas_salida", F.coalesce("filas_salida", F.lit(0)))
    return j.select(*keys, "filas_entrada", "filas_salida",
                    _retained_pct(F.col("filas_entrada"), F.col("filas_salida")).alias("pct_retenido"))


def audit_from_counts(bronze: DataFrame, written: DataFrame) -> DataFrame:
    """``audit_of_counts`` with the rows in counted over a bronze frame (no data column is read)."""
    rows_in = (bronze.groupBy("tipo_vehiculo", F.col("file_anio").alias("anio"), F.col("file_mes").alias("mes"))
                     .agg(F.count(F.lit(1)).alias("filas_entrada")))
    return audit_of_counts(rows_in, written)
