"""Feature tables and series preparation (A7–A9, A15, F8–F11, O2, O3, ML3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import contracts as C
from ..functions.numeric import round_half_up
from .facts import zone_features  # noqa: F401 - A7, from the contract of the gold tables

ZONE_FEATURES = ["total_viajes", "fare_promedio", "distancia_promedio", "duracion_promedio",
                 "hora_promedio_salida", "pct_hora_pico"]



def daily_series(trips: DataFrame) -> DataFrame:
    """Trips per type × day, with weekday, month and year of the day."""
    s = trips.groupBy("tipo_vehiculo", F.to_date("pickup_datetime").alias("fecha")) \
             .agg(F.count(F.lit(1)).alias("total_viajes"))
    return s.select("fecha", "total_viajes", F.dayofweek("fecha").alias("dia_semana"),
                    F.month("fecha").alias("mes"), F.year("fecha").alias("anio"), "tipo_vehiculo")


def series_stats(series: DataFrame) -> DataFrame:
    """Min / max / mean / sample standard deviation of daily trips per type."""
    return series.groupBy("tipo_vehiculo").agg(
        F.min("total_viajes").alias("min_viajes"), F.max("total_viajes").alias("max_viajes"),
        round_half_up(F.avg("total_viajes"), 4).alias("promedio"),
        round_half_up(F.stddev_samp("total_viajes"), 4).alias("desviacion"))


def excluded_days(spark, days: dict[str, tuple[str, ...]] = C.EXCLUDED_DAYS) -> DataFrame:
    """The listed bad days of each type (``tipo_vehiculo``, ``fecha``) as a local relation."""
    rows = [(t, d) for t, ds in days.items() for d in ds]
    return spark.createDataFrame(rows, "tipo_vehiculo string, d string").select("tipo_vehiculo", F.to_date("d").alias("fecha"))


def exclude_days(series: DataFrame, days: DataFrame) -> DataFrame:
    """drop the listed days of each type; the other types keep them."""
    return series.join(days, ["tipo_vehiculo", "fecha"], "left_anti")


def split_train_test(series: DataFrame, horizon: int = C.HORIZON_DAYS) -> DataFrame:
    """chronological split per type: cut = last day − horizon; train ≤ cut < test.

    The cut is a window maximum over each series' day rows (one row per day,
    so a window partition is bounded by the calendar, not by trips). Nothing
    is collected to the driver, and unlike joining the series back to its own
    per-type maximum, the source is aggregated once instead of twice.
    """
    w = Window.partitionBy("tipo_vehiculo")
    j = series.withColumn("corte", F.date_sub(F.max("fecha").over(w), horizon))
    return j.withColumn("conjunto", F.when(F.col("fecha") <= F.col("corte"), "train").otherwise("test"))


def lowest_days(series: DataFrame, k: int = 10) -> DataFrame:
    """O2: the k lowest-volume days of each series (ties broken by day)."""
    w = Window.partitionBy("tipo_vehiculo").orderBy("total_viajes", "fecha")
    return (series.withColumn("rango", F.row_number().over(w)).where(F.col("rango") <= k)
                  .select("tipo_vehiculo", "rango", "fecha", "total_viajes", "dia_semana"))


def top_zone_ids(features: DataFrame, k: int = 5) -> DataFrame:
    """O3: the k highest zone ids (a top-k report: TakeOrderedAndProject)."""
    return features.orderBy(F.col("location_id").desc_nulls_last()).limit(k)


def cluster_input(features: DataFrame) -> DataFrame:
    """geographic zones with complete features."""
    return features.where(~F.col("location_id").isin(*C.NON_GEO_ZONES)).dropna()


# The statistics of a describe, in its row order.
DESCRIBE_STATS = ("count", "mean", "std", "min", "25%", "50%", "75%", "max")


def _describe_stat(stat: str, c: str) -> Column:
    q = {"25%": 0.25, "50%": 0.5, "75%": 0.75}
    if stat in q:
        return F.percentile(c, q[stat])
    fn = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}[stat]
    return fn(c).cast("double")


def feature_summary(features: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Describe of every numeric column — one row per statistic, one column per feature.

    count (non-NULL), mean, sample standard deviation, min, quartiles by linear
    interpolation between order statistics, max; NULLs are skipped per column;
    values rounded half-up to 4 decimals. One aggregation computes all of them.
    The quartiles are exact (``percentile`` keeps each column's distinct values
    per aggregate), which is sound here because the zone table is bounded by the
    catalogue; an unbounded table would take ``percentile_approx``.
    """
    cols = cols or ["location_id", *ZONE_FEATURES]
    aggs = [round_half_up(_describe_stat(st, c), 4).alias(f"_{i}_{j}")
            for i, st in enumerate(DESCRIBE_STATS) for j, c in enumerate(cols)]
    rows = F.array(*[F.struct(F.lit(st).alias("estadistico"),
                              *[F.col(f"_{i}_{j}").alias(c) for j, c in enumerate(cols)])
                     for i, st in enumerate(DESCRIBE_STATS)])
    return features.agg(*aggs).select(F.explode(rows).alias("s")).select("s.*")


# One in this many trips goes into the classification features.
SAMPLE_ONE_IN = 100
_RESIDUE = 7


def row_sample(key: Column, one_in: int = SAMPLE_ONE_IN) -> Column:
    """A stable 1-in-``one_in`` sample predicate on a row key; 1 takes every row.

    Unlike ``DataFrame.sample`` it does not depend on partition layout, so
    re-runs and other engines select the same rows.
    """
    return F.pmod(key, F.lit(one_in)) == _RESIDUE % one_in


def default_trip_key() -> Column:
    """Row key for sampling silver trips that carry no id column."""
    return F.xxhash64("tipo_vehiculo", "pickup_datetime", "dropoff_datetime", "pu_location_id",
                      "do_location_id", "fare_amount", "trip_distance")


# Contract of the classification features: name, type, how it comes from a silver row.
AIRPORT_CONTRACT = (
    *((c, "double", lambda c=c: F.col(c)) for c in ("trip_distance", "duracion_min", "fare_amount")),
    ("hora", "int", lambda: F.col("hora")),
    ("dia_semana", "int", lambda: F.dayofweek("pickup_datetime")),
    *((f"es_{t}", "int", lambda t=t: F.col("tipo_vehiculo") == t) for t in C.VEHICLE_TYPES if t != "fhv"),
    ("target_aeropuerto", "int", lambda: F.col("do_location_id").isin(*C.AIRPORT_ZONES)),
    ("anio", "int", lambda: F.col("anio")),
)


def airport_features(silver: DataFrame, key: Column | None = None, one_in: int = SAMPLE_ONE_IN) -> DataFrame:
    """ML3: complete trip-level features for the airport-destination classifier, of one in ``one_in`` trips."""
    sampled = silver.where(row_sample(default_trip_key() if key is None else key, one_in))
    return sampled.select(*[build().cast(kind).alias(name) for name, kind, build in AIRPORT_CONTRACT]).dropna()
