"""Gold dimensions: zones (S5), calendar (S7/P12), US holidays (J6), fact ⋈ dim."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import calendar_attributes


def dim_location(zones_raw: DataFrame) -> DataFrame:
    """Zone catalogue in the raw CSV layout → ``dim_ubicacion``."""
    return zones_raw.select(F.col("LocationID").alias("location_id"), F.col("Borough").alias("borough"),
                            F.col("Zone").alias("zona"), F.col("service_zone").alias("tipo_zona"))


def calendar(days: DataFrame) -> DataFrame:
    """Calendar attributes for a frame with one ``fecha`` date column."""
    return days.select("fecha", *[c.alias(n) for n, c in calendar_attributes("fecha").items()])


def day_range(start: Column, end: Column, spark_df: DataFrame) -> DataFrame:
    """One row per day from ``start`` to ``end`` (date expressions over a 1-row frame)."""
    return spark_df.select(F.explode(F.sequence(start, end, F.expr("interval 1 day"))).alias("fecha"))


def calendar_years(bounds: DataFrame) -> DataFrame:
    """``dim_tiempo`` for whole years ``min_anio``..``max_anio`` of a 1-row bounds frame."""
    days = day_range(F.make_date(F.col("min_anio"), F.lit(1), F.lit(1)),
                     F.make_date(F.col("max_anio"), F.lit(12), F.lit(31)), bounds)
    return calendar(days)


def year_bounds(df: DataFrame, ts: str = "pickup_datetime") -> DataFrame:
    """1-row frame with the first and last year present in ``df`` (a global aggregate)."""
    return df.agg(F.min(F.year(ts)).alias("min_anio"), F.max(F.year(ts)).alias("max_anio"))


def partition_year_bounds(silver: DataFrame) -> DataFrame:
    """The same from stored silver's ``anio``: partition values, which are the pickups' years; no data column is read."""
    return silver.agg(F.min("anio").alias("min_anio"), F.max("anio").alias("max_anio"))


def _nth_weekday(year: Column, month: int, dow: str, n: int) -> Column:
    """n-th given weekday of a month (n ≥ 1)."""
    before = F.date_sub(F.make_date(year, F.lit(month), F.lit(1)), 1)
    return F.date_add(F.next_day(before, dow), 7 * (n - 1))


def _last_weekday(year: Column, month: int, last_day: int, dow: str) -> Column:
    return F.next_day(F.date_sub(F.make_date(year, F.lit(month), F.lit(last_day)), 7), dow)


def _observed(d: Column) -> Column:
    """Federal observance: Saturday → Friday before, Sunday → Monday after."""
    dow = F.dayofweek(d)
    return F.when(dow == 7, F.date_sub(d, 1)).when(dow == 1, F.date_add(d, 1)).otherwise(d)


# US federal holidays by rule (names as the public holiday calendars print them).
FIXED_DATE_HOLIDAYS = (("New Year's Day", 1, 1), ("Juneteenth National Independence Day", 6, 19),
                       ("Independence Day", 7, 4), ("Veterans Day", 11, 11), ("Christmas Day", 12, 25))
NTH_WEEKDAY_HOLIDAYS = (("Martin Luther King Jr. Day", 1, "MON", 3), ("Washington's Birthday", 2, "MON", 3),
                        ("Labor Day", 9, "MON", 1), ("Columbus Day", 10, "MON", 2),
                        ("Thanksgiving", 11, "THU", 4))
LAST_WEEKDAY_HOLIDAYS = (("Memorial Day", 5, 31, "MON"),)


def us_holidays(years: DataFrame) -> DataFrame:
    """US federal holidays for every ``anio`` in ``years`` (rule-based).

    Output ``fecha, feriado``; a fixed-date holiday falling on a weekend also
    gets its observed weekday as ``<name> (observed)``.
    """
    y = F.col("anio")
    entries = []
    for name, m, d in FIXED_DATE_HOLIDAYS:
        day = F.make_date(y, F.lit(m), F.lit(d))
        entries.append(F.struct(day.alias("fecha"), F.lit(name).alias("feriado")))
        entries.append(F.struct(F.when(_observed(day) != day, _observed(day)).alias("fecha"),
                                F.lit(f"{name} (observed)").alias("feriado")))
    for name, m, dow, n in NTH_WEEKDAY_HOLIDAYS:
        entries.append(F.struct(_nth_weekday(y, m, dow, n).alias("fecha"), F.lit(name).alias("feriado")))
    for name, m, last, dow in LAST_WEEKDAY_HOLIDAYS:
        entries.append(F.struct(_last_weekday(y, m, last, dow).alias("fecha"), F.lit(name).alias("feriado")))
    out = years.select(F.explode(F.array(*entries)).alias("h")).select("h.fecha", "h.feriado")
    return out.where(F.col("fecha").isNotNull())


def years_of(bounds: DataFrame) -> DataFrame:
    return bounds.select(F.explode(F.sequence(F.col("min_anio"), F.col("max_anio"))).alias("anio"))


def zone_report(zone_fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Zone totals per type enriched with the zone catalogue (Spark broadcasts it below its size threshold)."""
    totals = (zone_fact.groupBy("tipo_vehiculo", "location_id")
                       .agg(F.sum("total_viajes_origen").alias("total_viajes_origen"),
                            F.sum("total_viajes_destino").alias("total_viajes_destino")))
    return (totals.join(dim, on="location_id", how="left")
                  .select("tipo_vehiculo", "location_id", "borough", "zona", "tipo_zona",
                          "total_viajes_origen", "total_viajes_destino"))
