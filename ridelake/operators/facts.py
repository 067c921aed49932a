"""Gold fact tables over silver trips.

Each builder is one aggregation over all types and years at once: partial
(map-side) aggregation collapses each task's rows to its groups before the
exchange, so the shuffle carries groups, not trips, and a hot type or day
cannot overload a reducer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import contracts as C
from ..functions.numeric import round_half_up


def _pickup_day() -> dict[str, Column]:
    p = F.col("pickup_datetime")
    return {"anio": F.year(p), "mes": F.month(p), "dia": F.dayofmonth(p)}


def _pickup_day_keys() -> list[Column]:
    return [c.alias(n) for n, c in _pickup_day().items()]


def metric_guard(df: DataFrame, metrics: list[str]) -> DataFrame:
    """A missing metric becomes 0.0, a present one is cast to double."""
    present = set(df.columns)
    return df.withColumns({m: (F.col(m).cast("double") if m in present else F.lit(0.0)) for m in metrics})


def _peak() -> Column:
    return F.col("hora").isin(*C.PEAK_HOURS).cast("int")


def _from_trips(how: str, metric: str | None) -> Column:
    """A measure over trips."""
    if how == "trips":
        return F.count(F.lit(1))
    if how == "share":
        return round_half_up(F.avg(_peak()), 3)
    value = F.col(C.METRICS.get(metric, metric))
    return round_half_up(F.avg(value) if how == "mean" else F.sum(value))


def _from_base(how: str, metric: str | None) -> Column:
    """The same measure over a base of counts, sums and non-NULL counts; the hour is a key there."""
    n = F.sum("n")
    if how == "trips":
        return n
    if how == "share":
        return round_half_up(F.sum(_peak() * F.col("n")) / n, 3)
    if metric == "hora":
        return round_half_up(F.sum(F.col("hora") * F.col("n")) / n)
    total = F.sum(f"s_{metric}")
    return round_half_up(F.try_divide(total, F.sum(f"n_{metric}")) if how == "mean" else total)


def gold_table(rows: DataFrame, name: str, measure) -> DataFrame:
    """One gold table of the contract from ``rows`` that have its keys, with the contract's order and types."""
    columns = C.GOLD_TABLES[name]
    keys = [c for c in columns if len(c) == 2]
    out = rows.groupBy(*[k for k, _ in keys]).agg(*[measure(how, metric).alias(c[0]) for c in columns if len(c) == 3
                                                    for how, metric in [c[1:]]])
    kinds = {"trips": "bigint", "mean": "double", "total": "double", "share": "double"}
    return out.select(*[F.col(c[0]).cast(c[1] if len(c) == 2 else kinds[c[1]]).alias(c[0]) for c in columns])


def _table_of_trips(name: str):
    def build(silver: DataFrame) -> DataFrame:
        used = [C.METRICS[c[2]] for c in C.GOLD_TABLES[name] if len(c) == 3 and c[2] in C.METRICS]
        rows = metric_guard(silver, used).withColumns(_pickup_day()).withColumn("location_id", F.col("pu_location_id"))
        return gold_table(rows if name != "tarifas_por_zona" else rows.where(F.col("location_id").isNotNull()), name, _from_trips)
    build.__doc__ = f"``{name}``: one aggregation over trips."
    return build


trips_by_hour = _table_of_trips("viajes_por_hora")             # A1
monthly_trend = _table_of_trips("tendencia_mensual")           # A3
fares_by_zone = _table_of_trips("tarifas_por_zona")            # A4: NULL zones dropped
vehicle_comparison = _table_of_trips("comparacion_vehiculos")  # A5
duration_distance = _table_of_trips("duracion_distancia")      # A6
zone_features = _table_of_trips("features_clustering")         # A7


def trips_by_zone(silver: DataFrame) -> DataFrame:
    """Origin and destination trip counts per type × zone × day, one pass.

    Each trip is counted once as origin (its pickup zone) and once as
    destination (its dropoff zone) in a single aggregation instead of two
    aggregations joined: one scan, one exchange. The result equals the
    full outer join of the two counts on (zone, day, type) with missing
    sides as 0, including its NULL-key behaviour: NULL keys never match in
    a join, so NULL-origin and NULL-destination counts stay on separate
    rows; the ``_side`` key keeps them apart here.
    """
    sides = F.explode(F.array(
        F.struct(F.col("pu_location_id").alias("loc"), F.lit(True).alias("is_origin")),
        F.struct(F.col("do_location_id").alias("loc"), F.lit(False).alias("is_origin")),
    )).alias("s")
    p = F.col("pickup_datetime")
    long = silver.select("tipo_vehiculo", F.year(p).alias("anio"), F.month(p).alias("mes"),
                         F.dayofmonth(p).alias("dia"), sides)
    loc = F.col("s.loc")
    origin = F.col("s.is_origin")
    agg = (long.groupBy("tipo_vehiculo", loc.alias("location_id"), "anio", "mes", "dia",
                        F.when(loc.isNull(), origin).alias("_side"))
               .agg(F.sum(F.when(origin, 1).otherwise(0)).cast("long").alias("total_viajes_origen"),
                    F.sum(F.when(origin, 0).otherwise(1)).cast("long").alias("total_viajes_destino")))
    return agg.select("location_id", "anio", "mes", "dia", "total_viajes_origen",
                      "total_viajes_destino", "tipo_vehiculo")


# ---------------------------------------------------------------------------
# Hourly base: the grain every time-grain table rolls up from.
#
# A1, A3, A5 and A6 are all roll-ups of type × day × hour. The hourly base holds
# per-metric sums and non-NULL counts at that grain (≈ 4 types × 366 days × 24
# hours per year, independent of trip volume), so each table is derived from
# the small base instead of re-scanning silver: an average is sum / count over
# the rows where the metric is present, exactly as ``avg``. The base itself is
# rolled up from the zone-hour base below (``hourly_from_zone_base``).

_BASE_METRICS = {k: c for k, c in C.METRICS.items() if k != "total"}


def _table_of_base(name: str):
    def build(base: DataFrame) -> DataFrame:
        return gold_table(base, name, _from_base)
    build.__doc__ = f"``{name}`` rolled up from the hourly base."
    return build


trips_by_hour_from = _table_of_base("viajes_por_hora")
monthly_trend_from = _table_of_base("tendencia_mensual")
vehicle_comparison_from = _table_of_base("comparacion_vehiculos")
duration_distance_from = _table_of_base("duracion_distancia")


# ---------------------------------------------------------------------------
# Shared zone-hour base: one silver scan for every gold aggregate.
#
# Each trip is counted once on its origin side (pickup zone, with every metric)
# and once on its destination side (dropoff zone, count only), at the grain
# type × side × zone × day × hour. The base is bounded by the calendar and the
# zone catalogue (2 × types × zones × days × 24), not by trip volume, and every
# aggregate gold table is a roll-up of it: the hourly base and its tables
# (A1, A3, A5, A6), the zone fact (A2/J1), fares by zone (A4), the zone profile
# (A7) and the daily series (A8). Partial aggregation collapses each task's
# rows before the exchange, so a hot zone or day costs one row per task.

_ZONE_BASE_METRICS = C.METRICS


def zone_hour_base(silver: DataFrame) -> DataFrame:
    """Per type × side (``origen``) × zone × day × hour: trips, metric sums and non-NULL counts."""
    sides = F.explode(F.array(
        F.struct(F.col("pu_location_id").alias("location_id"), F.lit(True).alias("origen")),
        F.struct(F.col("do_location_id").alias("location_id"), F.lit(False).alias("origen")),
    )).alias("s")
    metrics = list(_ZONE_BASE_METRICS.values())
    long = silver.select("tipo_vehiculo", *_pickup_day_keys(), "hora", *metrics, sides)
    origin = F.col("s.origen")
    aggs = [F.count(F.lit(1)).alias("n")]
    for k, c in _ZONE_BASE_METRICS.items():
        v = F.when(origin, F.col(c).cast("double"))
        aggs += [F.sum(v).alias(f"s_{k}"), F.count(v).alias(f"n_{k}")]
    return long.groupBy("tipo_vehiculo", origin.alias("origen"), F.col("s.location_id").alias("location_id"),
                        "anio", "mes", "dia", "hora").agg(*aggs)


def _origin_side(base: DataFrame) -> DataFrame:
    return base.where(F.col("origen"))


def hourly_from_zone_base(base: DataFrame) -> DataFrame:
    """The hourly base (type × day × hour) rolled up from the origin side of the zone base."""
    aggs = [F.sum("n").alias("n")]
    for k in _BASE_METRICS:
        aggs += [F.sum(f"s_{k}").alias(f"s_{k}"), F.sum(f"n_{k}").alias(f"n_{k}")]
    return _origin_side(base).groupBy("tipo_vehiculo", "anio", "mes", "dia", "hora").agg(*aggs)


def trips_by_zone_from(base: DataFrame) -> DataFrame:
    """A2/J1 from the zone base: both sides per zone × day; NULL-zone sides kept apart as in the join."""
    origin = F.col("origen")
    loc = F.col("location_id")
    agg = (base.groupBy("tipo_vehiculo", loc, "anio", "mes", "dia", F.when(loc.isNull(), origin).alias("_side"))
               .agg(F.sum(F.when(origin, F.col("n")).otherwise(0)).cast("long").alias("total_viajes_origen"),
                    F.sum(F.when(origin, 0).otherwise(F.col("n"))).cast("long").alias("total_viajes_destino")))
    return agg.select("location_id", "anio", "mes", "dia", "total_viajes_origen",
                      "total_viajes_destino", "tipo_vehiculo")


def fares_by_zone_from(base: DataFrame) -> DataFrame:
    """A4 from the zone base (pickup side, NULL zones dropped)."""
    return gold_table(_origin_side(base).where(F.col("location_id").isNotNull()), "tarifas_por_zona", _from_base)


def zone_features_from(base: DataFrame) -> DataFrame:
    """A7 from the zone base: the hour is a key of the base, so its mean and the
    peak-hour share are count-weighted sums (exact integer arithmetic)."""
    return gold_table(_origin_side(base), "features_clustering", _from_base)


def daily_series_from(base: DataFrame) -> DataFrame:
    """A8 from the zone base: trips per type × day with weekday, month and year."""
    s = (_origin_side(base).groupBy("tipo_vehiculo", F.make_date("anio", "mes", "dia").alias("fecha"))
         .agg(F.sum("n").alias("total_viajes")))
    return s.select("fecha", "total_viajes", F.dayofweek("fecha").alias("dia_semana"),
                    F.month("fecha").alias("mes"), F.year("fecha").alias("anio"), "tipo_vehiculo")


def year_bounds_from(base: DataFrame) -> DataFrame:
    """First and last pickup year (1 row) from the base instead of a silver scan."""
    return base.agg(F.min("anio").alias("min_anio"), F.max("anio").alias("max_anio"))


def trips_by_zone_sql(spark, view: str) -> DataFrame:
    """A2/J2 in Spark SQL over a silver view of all types and years.

    ``stack`` turns a trip into its two ends and one grouping counts both, so the view
    is scanned once. Ends without a zone keep a row for each side (``sin_zona``).
    ``anio``/``mes`` are the silver partition values: the file month, which after the
    month rule is the pickup's.
    """
    return spark.sql("""
        WITH extremos AS (
          SELECT tipo_vehiculo, anio, mes, day(pickup_datetime) AS dia,
                 stack(2, 'origen', pu_location_id, 'destino', do_location_id) AS (lado, location_id)
          FROM {trips})
        SELECT location_id, anio, mes, dia,
               count_if(lado = 'origen') AS total_viajes_origen, count_if(lado = 'destino') AS total_viajes_destino,
               tipo_vehiculo
        FROM (SELECT *, if(location_id IS NULL, lado, NULL) AS sin_zona FROM extremos)
        GROUP BY tipo_vehiculo, location_id, anio, mes, dia, sin_zona""", trips=spark.table(view))
