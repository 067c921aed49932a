"""Fact-table invariants on the driver tables."""

from helpers import SF_SMALL, plain_zone_counts, zone_rows
from pyspark.sql import functions as F

from ridelake.operators import facts
from ridelake.queries import silver_df


def test_zone_one_pass_equals_plain_count(spark):
    s = silver_df(spark, SF_SMALL)
    assert zone_rows(facts.trips_by_zone(s)) == plain_zone_counts(s)


def test_zone_totals_equal_silver_rows(spark):
    s = silver_df(spark, SF_SMALL)
    n = s.count()
    tot = facts.trips_by_zone(s).agg(F.sum("total_viajes_origen"), F.sum("total_viajes_destino")).first()
    assert tot[0] == n and tot[1] == n


def test_hourly_counts_sum(spark):
    s = silver_df(spark, SF_SMALL)
    assert facts.trips_by_hour(s).agg(F.sum("total_viajes")).first()[0] == s.count()


def test_metric_guard_missing_and_cast(spark):
    df = spark.createDataFrame([(1,)], "fare_amount int")
    out = facts.metric_guard(df, ["fare_amount", "tip_amount"])
    assert dict(out.dtypes) == {"fare_amount": "double", "tip_amount": "double"}
    assert out.first().tip_amount == 0.0


def _same(a, b):
    assert a.schema.simpleString() == b.schema.simpleString()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_zone_base_rollups_equal_direct_aggregates(spark):
    """Every gold table rolled up from the zone-hour base equals its direct aggregate over silver."""
    from ridelake.operators import features
    s = silver_df(spark, SF_SMALL, multi=True)
    base = facts.zone_hour_base(s)
    hourly = facts.hourly_from_zone_base(base)
    _same(facts.trips_by_hour_from(hourly), facts.trips_by_hour(s))
    _same(facts.trips_by_zone_from(base), facts.trips_by_zone(s))
    _same(facts.fares_by_zone_from(base), facts.fares_by_zone(s))
    _same(facts.zone_features_from(base), features.zone_features(s))
    _same(facts.daily_series_from(base), features.daily_series(s))
    _same(facts.monthly_trend_from(hourly), facts.monthly_trend(s))


def test_zone_base_size_bounded_by_grain(spark):
    """The base has at most one row per type × side × zone × day × hour, whatever the trip count."""
    s = silver_df(spark, SF_SMALL, multi=True)
    base = facts.zone_hour_base(s)
    keys = ["tipo_vehiculo", "origen", "location_id", "anio", "mes", "dia", "hora"]
    assert base.count() == base.select(*keys).distinct().count()
    assert base.agg(F.sum("n")).first()[0] == 2 * s.count()


def test_gold_job_writes_every_table_equal_to_direct_aggregates(spark):
    """One run of the gold job: every table it writes, read back, equals the direct aggregate."""
    from ridelake.operators import dims, features
    from ridelake.plans import gold_job
    from ridelake.session import scratch_path
    from ridelake.sources import writers as WR
    root = scratch_path(spark, "gold-job-all")
    WR.write_silver(silver_df(spark, SF_SMALL, multi=True), f"{root}/silver")
    s = spark.read.parquet(f"{root}/silver")
    paths = gold_job.run(spark, f"{root}/silver", f"{root}/gold")
    direct = {
        "descriptivo/viajes_por_hora": facts.trips_by_hour(s),
        "descriptivo/viajes_por_zona": facts.trips_by_zone(s),
        "descriptivo/tendencia_mensual": facts.monthly_trend(s),
        "diagnostico/tarifas_por_zona": facts.fares_by_zone(s),
        "diagnostico/comparacion_vehiculos": facts.vehicle_comparison(s),
        "diagnostico/duracion_distancia": facts.duration_distance(s),
        "predictivo/features_serie_tiempo": features.daily_series(s),
        "predictivo/features_clustering": features.zone_features(s),
        "dims/dim_tiempo": dims.calendar_years(dims.year_bounds(s)),
    }
    assert set(direct) <= set(paths)
    for name, want in direct.items():
        got = spark.read.parquet(paths[name]).select(*want.columns)
        want = want.select(*[F.col(c).cast(t) for c, t in got.dtypes])  # partition columns read back as int
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0, name
