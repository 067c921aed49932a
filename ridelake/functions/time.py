"""Date and time expressions shared by the rules and the facts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def duration_minutes(pickup: str = "pickup_datetime", dropoff: str = "dropoff_datetime") -> Column:
    """Trip duration in minutes from whole-second epoch values."""
    return (F.unix_timestamp(F.col(dropoff)) - F.unix_timestamp(F.col(pickup))) / 60


def calendar_attributes(day: str = "fecha") -> dict[str, Column]:
    """Calendar columns for a date column (names of the calendar dimension)."""
    d = F.col(day)
    return {
        "anio": F.year(d),
        "mes": F.month(d),
        "nombre_mes": F.date_format(d, "MMMM"),
        "dia": F.dayofmonth(d),
        "dia_semana_num": F.dayofweek(d),
        "nombre_dia": F.date_format(d, "EEEE"),
        "trimestre": F.quarter(d),
        "es_fin_semana": F.dayofweek(d).isin(1, 7),
    }
