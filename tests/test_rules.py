"""Boundary rows for every cleaning rule (values just below, at and above each threshold)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from helpers import trip, frame

from ridelake.operators import silver

CASES = [
    # (row kwargs, kept?)
    (dict(tipo="yellow", fare=-0.01, payment=1), False),
    (dict(tipo="yellow", fare=-0.01, payment=3), True),
    (dict(tipo="yellow", fare=-0.01, payment=4), True),
    (dict(tipo="yellow", fare=-0.01, payment=5), False),
    (dict(tipo="yellow", fare=-0.01, payment=None), False),
    (dict(tipo="yellow", fare=0.0, payment=None), True),
    (dict(tipo="yellow", fare=300.0), True),
    (dict(tipo="yellow", fare=300.01), False),
    (dict(tipo="yellow", dist=80.0), True),
    (dict(tipo="yellow", dist=80.01), False),
    (dict(tipo="yellow", minutes=59 / 60), False),
    (dict(tipo="yellow", minutes=1.0), True),
    (dict(tipo="yellow", minutes=200.0), True),
    (dict(tipo="yellow", minutes=200 + 1 / 60), False),
    (dict(tipo="yellow", dist=0.0, minutes=3.0), True),
    (dict(tipo="yellow", dist=0.0, minutes=3 + 1 / 60), False),
    (dict(tipo="yellow", dist=None), False),
    (dict(tipo="green", fare=2.49), False),
    (dict(tipo="green", fare=2.50), True),
    (dict(tipo="green", fare=-1.0, payment=3), False),
    (dict(tipo="fhv", fare=None, dist=None, payment=None, driver_pay=None), True),
    (dict(tipo="fhv", pu=None, fare=None, dist=None), False),
    (dict(tipo="fhv", do=None, fare=None, dist=None), False),
    (dict(tipo="fhvhv", fare=2.49), False),
    (dict(tipo="fhvhv", fare=2.50, payment=None), True),
    (dict(tipo="fhvhv", driver_pay=0.0), False),
    (dict(tipo="fhvhv", dist=150.0), True),
    (dict(tipo="fhvhv", dist=150.01), False),
    (dict(tipo="fhvhv", fare=500.0), True),
    (dict(tipo="yellow", pickup=dt.datetime(2024, 1, 31, 23, 59, 59)), True),
    (dict(tipo="yellow", pickup=dt.datetime(2024, 2, 1, 0, 0, 0)), False),
    (dict(tipo="yellow", pickup=dt.datetime(2023, 12, 31, 23, 59, 59)), False),
    (dict(tipo="yellow", pickup=dt.datetime(2024, 12, 15), file_anio=2024, file_mes=12), True),
    (dict(tipo="other"), False),
]


@pytest.mark.parametrize("kw,kept", CASES)
def test_rule_boundaries(spark, kw, kept):
    out = silver.clean(frame(spark, [trip(**kw)])).count()
    assert out == (1 if kept else 0)


def test_clean_and_audit_agree(spark):
    rows = [trip(trip_id=i, **kw) for i, (kw, _) in enumerate(CASES)]
    df = frame(spark, rows)
    expected = sum(1 for _, k in CASES if k)
    assert silver.clean(df).count() == expected
    audit = silver.audit(df).groupBy().sum("filas_entrada", "filas_salida").first()
    assert audit[0] == len(CASES) and audit[1] == expected


def test_derived_columns_use_file_month(spark):
    row = trip(pickup=dt.datetime(2024, 1, 7, 23, 30), minutes=45)
    out = silver.clean(frame(spark, [row])).first()
    assert out.duracion_min == 45.0 and out.hora == 23 and out.dia_semana == 1  # Sunday
    assert (out.anio, out.mes) == (2024, 1)


def test_duration_is_wall_clock_across_dst(spark):
    """Trip timestamps are wall-clock (timestamp_ntz): 01:30 → 03:30 on the 2023-03-12 DST change is
    120 minutes in the New York session zone, not the 60 an instant-based timestamp would give."""
    assert spark.conf.get("spark.sql.session.timeZone") == "America/New_York"
    row = trip(pickup=dt.datetime(2023, 3, 12, 1, 30), minutes=120, file_anio=2023, file_mes=3)
    df = frame(spark, [row])
    assert dict(df.dtypes)["pickup_datetime"] == "timestamp_ntz"
    out = silver.clean(df).first()
    assert out.duracion_min == 120.0 and out.hora == 1


def test_wrong_and_missing_file_months(spark):
    """A row goes where its file's month is another one, is missing, or its pickup is."""
    rows = [trip(trip_id=1), trip(trip_id=2, file_mes=2), trip(trip_id=3, file_anio=2023), trip(trip_id=4)]
    df = frame(spark, rows)
    df = df.withColumn("file_ym", F.when(F.col("trip_id") != 4, F.col("file_ym")))
    df = df.unionByName(df.where("trip_id = 1").withColumns({"trip_id": F.lit(5).cast("long"), "pickup_datetime": F.lit(None).cast("timestamp_ntz")}))
    assert [r.trip_id for r in silver.clean(df, keep=("trip_id",)).collect()] == [1]
