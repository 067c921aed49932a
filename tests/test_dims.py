"""Calendar and holiday dimensions."""

import datetime as dt

from pyspark.sql import functions as F

from ridelake.operators import dims


def _years(spark, a, b):
    return spark.range(1).select(F.lit(a).alias("min_anio"), F.lit(b).alias("max_anio"))


def test_calendar_2023_2025(spark):
    cal = dims.calendar_years(_years(spark, 2023, 2025))
    assert cal.count() == 1096
    r = cal.where(F.col("fecha") == "2024-03-02").first()
    assert (r.nombre_mes, r.nombre_dia, r.trimestre, r.es_fin_semana, r.dia_semana_num) == \
        ("March", "Saturday", 1, True, 7)


def test_us_holidays(spark):
    h = {(r.feriado, r.fecha) for r in dims.us_holidays(dims.years_of(_years(spark, 2023, 2027))).collect()}
    d = dt.date
    for expected in [("Thanksgiving", d(2023, 11, 23)), ("Thanksgiving", d(2024, 11, 28)),
                     ("Thanksgiving", d(2025, 11, 27)), ("Martin Luther King Jr. Day", d(2024, 1, 15)),
                     ("Memorial Day", d(2024, 5, 27)), ("Memorial Day", d(2025, 5, 26)),
                     ("Labor Day", d(2025, 9, 1)), ("Columbus Day", d(2023, 10, 9)),
                     ("Washington's Birthday", d(2025, 2, 17)),
                     ("Independence Day (observed)", d(2026, 7, 3)),
                     ("Juneteenth National Independence Day (observed)", d(2027, 6, 18)),
                     ("Christmas Day (observed)", d(2027, 12, 24)),
                     ("New Year's Day (observed)", d(2023, 1, 2))]:
        assert expected in h, expected
