"""Property tests for the quality reports over random trip rows."""

import datetime as dt

from helpers import trip, frame
from hypothesis import given, settings
from hypothesis import strategies as st

from ridelake.operators import quality as QL
from ridelake.operators import silver

row = st.builds(
    lambda fare, dist, minutes, pay, day, fm: trip(
        tipo="yellow", fare=fare, dist=dist, minutes=minutes, payment=pay,
        pickup=dt.datetime(2024, 1, 1) + dt.timedelta(days=day), file_mes=fm),
    fare=st.one_of(st.none(), st.floats(-50, 400, allow_nan=False)),
    dist=st.one_of(st.none(), st.floats(-1, 100, allow_nan=False)),
    minutes=st.floats(0, 250, allow_nan=False),
    pay=st.one_of(st.none(), st.integers(0, 6)),
    day=st.integers(0, 40), fm=st.integers(1, 2))


@settings(max_examples=5, deadline=None)
@given(st.lists(row, min_size=1, max_size=40))
def test_cascade_sums_to_input(spark, rows):
    df = frame(spark, rows)
    casc = QL.rule_cascade(df).orderBy("paso").collect()
    removed = sum(r.filas_eliminadas for r in casc)
    assert casc[-1].filas_restantes == len(rows) - removed
    remaining = [r.filas_restantes for r in casc]
    assert remaining == sorted(remaining, reverse=True)
    assert all(0 <= r.pct_del_total_inicial <= 100 for r in casc)
    # Kept by the cascade ⊆ kept by the cleaning rule (the cascade drops every negative fare).
    assert casc[-1].filas_restantes <= silver.clean(df).count()


@settings(max_examples=5, deadline=None)
@given(st.lists(row, min_size=1, max_size=40))
def test_audit_pct_in_range(spark, rows):
    a = silver.audit(frame(spark, rows)).collect()
    assert sum(r.filas_entrada for r in a) == len(rows)
    assert all(0 <= r.pct_retenido <= 100 for r in a)


def test_profile_severity_labels(spark):
    rows = [trip(trip_id=i, fare=(400.0 if i < 3 else 10.0)) for i in range(100)]
    sev = {r.regla: (r.filas, r.estado) for r in QL.rule_severity(QL.rule_profile(frame(spark, rows))).collect()}
    assert sev["eliminar_fare_extremo"] == (3, "REVISAR")
    assert sev["eliminar_sin_origen"] == (0, "OK")
    assert "eliminar_driver_pay_invalido" not in sev  # fhvhv-only rule


def test_audit_latest(spark):
    """The latest run time wins; equal run times go by the run id."""
    log = spark.createDataFrame(
        [("yellow", 2023, 1, 10, 9, 1, "r1"), ("yellow", 2023, 1, 10, 8, 2, "r2"), ("green", 2023, 1, 5, 5, 1, "r1"),
         ("fhv", 2023, 1, 6, 6, 3, "r3"), ("fhv", 2023, 1, 6, 4, 3, "r4")],
        "tipo_vehiculo string, anio int, mes int, filas_entrada long, filas_salida long, run_ts int, run_id string")
    got = {(r.tipo_vehiculo, r.filas_salida) for r in QL.audit_latest(log).collect()}
    assert got == {("yellow", 8), ("green", 5), ("fhv", 4)}


def test_audit_from_counts_keeps_months_with_no_surviving_rows(spark):
    """A month whose rows all fail has no silver partition; its audit row says 0 out, 0 %."""
    from ridelake.contracts import SILVER_PARTITIONS
    good = [trip(trip_id=i) for i in range(3)]
    bad = [trip(trip_id=10 + i, fare=-5.0, payment=1, file_mes=2,
                pickup=dt.datetime(2024, 2, 3, 10, 0)) for i in range(4)]
    df = frame(spark, good + bad)
    written = silver.clean(df).select(*SILVER_PARTITIONS)
    a = {(r.anio, r.mes): r for r in silver.audit_from_counts(df, written).collect()}
    assert (a[(2024, 1)].filas_entrada, a[(2024, 1)].filas_salida, a[(2024, 1)].pct_retenido) == (3, 3, 100.0)
    assert (a[(2024, 2)].filas_entrada, a[(2024, 2)].filas_salida, a[(2024, 2)].pct_retenido) == (4, 0, 0.0)
    direct = silver.audit(df)
    got = silver.audit_from_counts(df, written)
    assert got.exceptAll(direct).count() == 0 and direct.exceptAll(got).count() == 0
