"""Table folders and hand-made trip rows for tests."""

from __future__ import annotations

import datetime as dt
from collections import Counter

from pyspark.sql import functions as F

from ridelake.contracts import CONFORMED_FIELDS

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"

BASE = dt.datetime(2024, 1, 10, 12, 0, 0)


def trip(tipo="yellow", minutes=10.0, fare=10.0, dist=2.0, payment=1, pu=1, do=2, driver_pay=5.0,
         pickup=BASE, file_anio=2024, file_mes=1, trip_id=0):
    return dict(trip_id=trip_id, tipo_vehiculo=tipo, file_anio=file_anio, file_mes=file_mes,
                pickup_datetime=pickup, dropoff_datetime=pickup + dt.timedelta(seconds=round(minutes * 60)),
                pu_location_id=pu, do_location_id=do, fare_amount=fare, tip_amount=None, total_amount=None,
                driver_pay=driver_pay, tolls_amount=None, congestion_surcharge=None, airport_fee=None,
                trip_distance=dist, trip_time_sec=None, passenger_count=None, payment_type=payment)


def frame(spark, rows):
    fields = ", ".join(f"{n} {t.simpleString()}" for n, t in CONFORMED_FIELDS)
    schema = f"trip_id long, file_anio int, file_mes int, {fields}"
    df = spark.createDataFrame([{k: r[k] for k in r} for r in rows], schema)
    df = df.withColumn("file_ym", F.col("file_anio") * 100 + F.col("file_mes"))
    return df.withColumn("pickup_datetime", F.col("pickup_datetime").cast("timestamp_ntz")) \
             .withColumn("dropoff_datetime", F.col("dropoff_datetime").cast("timestamp_ntz"))


def plain_zone_counts(silver) -> dict:
    """Trips that leave and reach each zone per type and day, counted one by one in Python.

    Zones are matched as a join would: ends without a zone are never matched, so they are counted per side.
    """
    leave, reach = Counter(), Counter()
    for r in silver.select("tipo_vehiculo", "pickup_datetime", "pu_location_id", "do_location_id").collect():
        day = (r.pickup_datetime.year, r.pickup_datetime.month, r.pickup_datetime.day, r.tipo_vehiculo)
        leave[(r.pu_location_id, *day)] += 1
        reach[(r.do_location_id, *day)] += 1
    matched = {k for k in leave.keys() | reach.keys() if k[0] is not None}
    out = Counter((*k, leave[k], reach[k]) for k in matched)
    out.update((*k, n, 0) for k, n in leave.items() if k[0] is None)
    out.update((*k, 0, n) for k, n in reach.items() if k[0] is None)
    return out


def zone_rows(table) -> Counter:
    """The rows of a zone fact in the form of ``plain_zone_counts``."""
    return Counter(tuple(r) for r in table.select(
        "location_id", "anio", "mes", "dia", "tipo_vehiculo", "total_viajes_origen", "total_viajes_destino").collect())
