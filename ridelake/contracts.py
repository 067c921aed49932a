"""Fixed values of the trip data contract.

Fixed values that must equal the reference's for equal results (thresholds,
code sets, zone ids, dates, labels), stated together in natural order:

- vehicle types: yellow, green, fhv, fhvhv
- years processed: 2023, 2024, 2025
- fare_amount maximum 300; fare minimum 2.50 (green, fhvhv)
- trip distance maximum 80 (yellow, green), 150 (fhvhv)
- duration minimum 1 minute, maximum 200 minutes
- GPS check: distance <= 0 with duration above 3 minutes is invalid
- payment types for which a negative fare is valid: 3, 4
- payment types for which a negative fare is an error: 0, 1, 2
- airport zones (classification target): 1, 132, 138
- peak hours: 7, 8, 17, 18
- non-geographic zones: 264, 265
- ingest-failure days excluded from the yellow series (and no other): 2023-09-22, 2023-09-23, 2023-09-24
- forecast horizon and hold-out: 90 days
- severity labels: OK (0 %), BAJO (<= 1 %), REVISAR (<= 5 %), CRITICO (above)
- cluster count 4; elbow k = 2..9, 10 restarts, seed 42
- download months: 2023-2025 all twelve, 2026 months 1-5
"""

from __future__ import annotations

from pyspark.sql import types as T

VEHICLE_TYPES = ("yellow", "green", "fhv", "fhvhv")
YEARS = (2023, 2024, 2025)

FARE_MAX = 300.0
FARE_MIN = 2.50
DISTANCE_MAX_TAXI = 80.0
DISTANCE_MAX_FHVHV = 150.0
DURATION_MIN = 1.0
DURATION_MAX = 200.0
GPS_CHECK_MINUTES = 3.0
NEGATIVE_FARE_OK_PAYMENTS = (3, 4)
NEGATIVE_FARE_ERROR_PAYMENTS = (0, 1, 2)

AIRPORT_ZONES = (1, 132, 138)
PEAK_HOURS = (7, 8, 17, 18)
NON_GEO_ZONES = (264, 265)
EXCLUDED_DAYS = {"yellow": ("2023-09-22", "2023-09-23", "2023-09-24")}
HORIZON_DAYS = 90

SEVERITY_LEVELS = (("OK", 0.0), ("BAJO", 1.0), ("REVISAR", 5.0), ("CRITICO", None))

N_CLUSTERS = 4
ELBOW_K = tuple(range(2, 10))
ELBOW_RESTARTS = 10
SEED = 42

DOWNLOAD_MONTHS = {2023: tuple(range(1, 13)), 2024: tuple(range(1, 13)),
                   2025: tuple(range(1, 13)), 2026: tuple(range(1, 6))}
FILE_PREFIX = {"yellow": "yellow_tripdata", "green": "green_tripdata",
               "fhv": "fhv_tripdata", "fhvhv": "fhvhv_tripdata"}

# Unified silver trip schema (column order is the contract).
CONFORMED_FIELDS = (
    ("tipo_vehiculo", T.StringType()),
    ("pickup_datetime", T.TimestampNTZType()),
    ("dropoff_datetime", T.TimestampNTZType()),
    ("pu_location_id", T.LongType()),
    ("do_location_id", T.LongType()),
    ("fare_amount", T.DoubleType()),
    ("tip_amount", T.DoubleType()),
    ("total_amount", T.DoubleType()),
    ("driver_pay", T.DoubleType()),
    ("tolls_amount", T.DoubleType()),
    ("congestion_surcharge", T.DoubleType()),
    ("airport_fee", T.DoubleType()),
    ("trip_distance", T.DoubleType()),
    ("trip_time_sec", T.LongType()),
    ("passenger_count", T.DoubleType()),
    ("payment_type", T.IntegerType()),
)
DERIVED_FIELDS = (
    ("duracion_min", T.DoubleType()),
    ("hora", T.IntegerType()),
    ("dia_semana", T.IntegerType()),
    ("mes", T.IntegerType()),
    ("anio", T.IntegerType()),
)
CONFORMED_COLUMNS = tuple(n for n, _ in CONFORMED_FIELDS)
SILVER_COLUMNS = CONFORMED_COLUMNS + tuple(n for n, _ in DERIVED_FIELDS)
SILVER_SCHEMA = T.StructType([T.StructField(n, t) for n, t in CONFORMED_FIELDS + DERIVED_FIELDS])
SILVER_PARTITIONS = ("tipo_vehiculo", "anio", "mes")

# Gold tables: their columns in order. A pair is a grouping key and its type; a triple is a measure:
# name, how it is taken ("trips", "mean" or "total", "share" of trips) and of which metric of a trip.
METRICS = {"fare": "fare_amount", "tip": "tip_amount", "total": "total_amount", "dist": "trip_distance",
           "dur": "duracion_min", "pass": "passenger_count"}
_TYPE, _YEAR, _MONTH, _HOUR = ("tipo_vehiculo", "string"), ("anio", "int"), ("mes", "int"), ("hora", "int")
_TRIPS, _FARE = ("total_viajes", "trips", None), ("fare_promedio", "mean", "fare")
_DISTANCE, _DURATION = ("distancia_promedio", "mean", "dist"), ("duracion_promedio", "mean", "dur")
_TIP, _INCOME = ("tip_promedio", "mean", "tip"), ("ingreso_total", "total", "fare")
_DURATION_MIN = ("duracion_promedio_min", "mean", "dur")
GOLD_TABLES = {
    "viajes_por_hora": (_YEAR, _MONTH, ("dia", "int"), _HOUR, _TRIPS, _DURATION_MIN, _FARE, _TYPE),
    "tendencia_mensual": (_YEAR, _MONTH, _TRIPS, _FARE, _INCOME, _DISTANCE, _DURATION_MIN, _TYPE),
    "tarifas_por_zona": (("location_id", "int"), _YEAR, _MONTH, _TRIPS, _FARE, _TIP,
                         ("total_promedio", "mean", "total"), _DURATION, _TYPE),
    "comparacion_vehiculos": (_TYPE, _YEAR, _MONTH, _TRIPS, _FARE, _TIP, _DISTANCE, _DURATION,
                              ("pasajeros_promedio", "mean", "pass"), _INCOME),
    "duracion_distancia": (_TYPE, _YEAR, _MONTH, _HOUR, _DISTANCE, _DURATION, _FARE, _TRIPS),
    "features_clustering": (("location_id", "bigint"), _TRIPS, _FARE, _DISTANCE, _DURATION,
                            ("hora_promedio_salida", "mean", "hora"), ("pct_hora_pico", "share", "peak")),
}
