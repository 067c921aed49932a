"""Data-quality reports.

Every report is a roll-up of one histogram: rule outcomes are a bitmask per row, made
in a projection that moves below the union into each type's scan (where the rules of
the other types fold away), and rows are counted by mask. So a report costs one
scan whatever the number of rules, and several reports can share the histogram.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import contracts as C
from ..functions.numeric import count_if, round_half_up
from .rules import cascade_steps, counted_rules, verdict


MONTH_KEYS = ("tipo_vehiculo", "anio", "mes")


def rule_histogram(bronze: DataFrame, parts: tuple[str, ...] = ("reglas", "paso", "ok", "reembolso")) -> DataFrame:
    """Rows ``n`` per type, file month and outcome; all that the reports need of the rows.

    ``reglas``: a bit per counted rule (in name order) that the row breaks; ``paso``: first failed step of the
    cascade, 0 if none; ``ok``: whether cleaning keeps the row; ``reembolso``: a valid refund the cascade's
    range step would remove. A report asks for the parts it reads.
    """
    made = {}
    if "reglas" in parts:
        made["reglas"] = sum((F.when(breaks, 1 << i).otherwise(0) for i, (breaks, _) in enumerate(counted_rules().values())), F.lit(0))
    if "paso" in parts or "reembolso" in parts:
        made["paso"] = first_failed_step(cascade_steps())
    if "ok" in parts:
        made["ok"] = verdict()
    if "reembolso" in parts:
        made["reembolso"] = (F.col("fare_amount") < 0) & ~F.col("payment_type").isin(*C.NEGATIVE_FARE_ERROR_PAYMENTS)
    rows = bronze.select("tipo_vehiculo", F.col("file_anio").alias("anio"), F.col("file_mes").alias("mes"),
                         *[c.alias(k) for k, c in made.items()])
    return rows.groupBy(*MONTH_KEYS, *made).agg(F.count(F.lit(1)).alias("n"))


def _rows_where(condition: Column) -> Column:
    return F.sum(F.when(condition, F.col("n")).otherwise(0)).cast("long")


def rule_profile(bronze: DataFrame, histogram: DataFrame | None = None) -> DataFrame:
    """Q1: per type × file month, rows each rule would remove, in long form.

    Output ``tipo_vehiculo, anio, mes, regla, total_original, filas``. A rule that does not
    apply to a type yields NULL and is dropped after the unpivot.
    """
    h = rule_histogram(bronze, ("reglas",)) if histogram is None else histogram
    rules = {name: types for name, (_, types) in counted_rules().items()}
    broken = [F.when(F.max(F.col("tipo_vehiculo").isin(*types)), _rows_where(F.col("reglas").bitwiseAND(1 << i) != 0)).alias(name)
              for i, (name, types) in enumerate(rules.items())]
    wide = h.groupBy(*MONTH_KEYS).agg(F.sum("n").alias("total_original"), *broken)
    long = wide.unpivot([*MONTH_KEYS, "total_original"], list(rules), "regla", "filas")
    return long.where(F.col("filas").isNotNull())


def severity(pct: Column) -> Column:
    """Label of a removal share in percent."""
    (ok, _), (low, low_max), (review, review_max), (crit, _) = C.SEVERITY_LEVELS
    return (F.when(pct == 0, ok).when(pct <= low_max, low).when(pct <= review_max, review).otherwise(crit))


def rule_severity(profile: DataFrame) -> DataFrame:
    """Share of rows each rule removes and its severity label."""
    pct = F.col("filas") * 100.0 / F.col("total_original")
    return profile.select("tipo_vehiculo", "anio", "mes", "regla", "filas",
                          round_half_up(pct).alias("pct"), severity(pct).alias("estado"))


def first_failed_step(steps: list[tuple[str, Column]]) -> Column:
    """Index (1-based) of the first step whose keep-condition is not true; 0 if all hold."""
    expr = None
    for i, (_, keep) in enumerate(steps, start=1):
        fail = ~F.coalesce(keep, F.lit(False))
        expr = F.when(fail, i) if expr is None else expr.when(fail, i)
    return expr.otherwise(0)


def rule_cascade(bronze: DataFrame, by: tuple[str, ...] = ("tipo_vehiculo",), histogram: DataFrame | None = None) -> DataFrame:
    """Q2: rows removed and remaining after each ordered rule, per ``by`` (type, or type and file month).

    One scan: each row is tagged with its first failing step and counted;
    the remaining-rows column is a running sum over the six step rows.
    """
    steps = cascade_steps()
    h = rule_histogram(bronze, ("paso",)) if histogram is None else histogram
    h = h.withColumns({"file_anio": F.col("anio"), "file_mes": F.col("mes")})
    wide = h.groupBy(*by).agg(F.sum("n").alias("n_inicial"),
                              *[_rows_where(F.col("paso") == i).alias(f"s{i}") for i in range(1, len(steps) + 1)])
    stack = F.explode(F.array(*[
        F.struct(F.lit(i).alias("paso"), F.lit(label).alias("regla"), F.col(f"s{i}").alias("filas_eliminadas"))
        for i, (label, _) in enumerate(steps, start=1)])).alias("st")
    long = wide.select(*by, "n_inicial", stack).select(*by, "n_inicial", "st.*")
    w = Window.partitionBy(*by).orderBy("paso").rowsBetween(Window.unboundedPreceding, 0)
    return long.select(
        *by, "paso", "regla", "filas_eliminadas",
        (F.col("n_inicial") - F.sum("filas_eliminadas").over(w)).alias("filas_restantes"),
        round_half_up(F.col("filas_eliminadas") * 100.0 / F.col("n_inicial"), 3).alias("pct_del_total_inicial"),
    )


def lost_refunds(bronze: DataFrame, histogram: DataFrame | None = None) -> DataFrame:
    """Q3: negative fares with a payment outside (0,1,2) still present after steps 1–2.

    These rows are valid refunds under the cleaning rule but are removed by
    the cascade's stricter fare-range step.
    """
    h = rule_histogram(bronze, ("reembolso",)) if histogram is None else histogram
    lost = ((F.col("paso") == 0) | (F.col("paso") > 2)) & F.col("reembolso")
    return h.groupBy("tipo_vehiculo").agg(_rows_where(lost).alias("filas_perdidas"))


def layer_audit(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Bronze vs silver rows per type × year (pairs missing on a side are skipped)."""
    b = bronze.groupBy("tipo_vehiculo", F.col("file_anio").alias("anio")).agg(F.count(F.lit(1)).alias("filas_bronze"))
    s = silver.groupBy("tipo_vehiculo", "anio").agg(F.count(F.lit(1)).alias("filas_silver"))
    j = b.join(s, ["tipo_vehiculo", "anio"], "inner")
    return j.select("tipo_vehiculo", "anio", "filas_bronze", "filas_silver",
                    (F.col("filas_bronze") - F.col("filas_silver")).alias("filas_eliminadas"),
                    F.when(F.col("filas_bronze") > 0,
                           round_half_up(F.col("filas_silver") * 100.0 / F.col("filas_bronze")))
                     .alias("pct_retenido"))


def audit_latest(audit_log: DataFrame) -> DataFrame:
    """Q4: the latest audit entry per (type, year, month) of a log with repeats, by run time (ties: run id)."""
    w = Window.partitionBy("tipo_vehiculo", "anio", "mes").orderBy(F.col("run_ts").desc(), F.col("run_id").desc())
    return audit_log.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def count_by_type_sql(silver: DataFrame, view: str = "trips") -> DataFrame:
    """Trips per type through a temporary view and Spark SQL."""
    silver.createOrReplaceTempView(view)
    return silver.sparkSession.sql(
        f"SELECT tipo_vehiculo, COUNT(*) AS total_viajes FROM {view} GROUP BY tipo_vehiculo")


def partition_count(silver: DataFrame) -> DataFrame:
    """Month partitions and rows per type."""
    return silver.groupBy("tipo_vehiculo").agg(
        F.count_distinct("anio", "mes").alias("particiones"), F.count(F.lit(1)).alias("filas"))


def null_profile(df: DataFrame) -> DataFrame:
    """NULL count of every column, one row per column."""
    counts = df.agg(*[count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "columna", "nulos")
