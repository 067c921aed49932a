"""Sources and sinks: schema drift, glob scans, dynamic overwrite, CSV, manifest."""

from pyspark.sql import functions as F

from ridelake.operators import manifest as MF
from ridelake.session import scratch_path
from ridelake.sources import bronze as BR
from ridelake.sources import writers as WR
from ridelake.sources import zones as ZN


def test_months_of_different_types_are_read_together(spark):
    root = scratch_path(spark, "drift")
    base = spark.range(3).select(F.lit("2024-01-01 10:00:00").cast("timestamp_ntz").alias("pickup_datetime"),
                                 F.lit("2024-01-01 10:20:00").cast("timestamp_ntz").alias("dropOff_datetime"))
    for month, typ in ((1, "int"), (2, "long"), (3, "double")):
        base.select("*", F.lit(7).cast(typ).alias("PUlocationID"), F.lit(8).cast(typ).alias("DOlocationID")) \
            .write.parquet(f"{root}/fhv_tripdata_2024-{month:02d}.parquet")
    df = BR.read_bronze(spark, root, "fhv")
    assert dict(df.dtypes)["PUlocationID"] == "bigint"
    got = sorted((r.file_ym, r.file_mes, r.PUlocationID) for r in df.collect())
    assert got == [(202400 + m, m, 7) for m in (1, 2, 3) for _ in range(3)]
    assert len(BR.schema_groups(spark, {"fhv": [root]})["fhv"]) == 3
    one = BR.read_bronze(spark, f"{root}/fhv_tripdata_2024-0[12].parquet", "fhv")  # a glob
    assert sorted({r.file_mes for r in one.collect()}) == [1, 2]


def test_no_files_read_as_no_rows(spark):
    path = scratch_path(spark, "nothing")
    spark.createDataFrame([], "a int").write.parquet(path)
    assert BR.read_bronze(spark, path + "/none-yet", "green").count() == 0


def _silver(spark, root):
    return WR.read_silver(spark, f"{root}/silver")


def test_silver_job_over_drifting_files_equals_the_uniform_ones(spark):
    from helpers import SF_SMALL
    from ridelake.operators import silver
    from ridelake.plans import silver_job
    from ridelake.sources import fixtures as FX
    root = scratch_path(spark, "drift-job")
    b = FX.trips_bronze(spark, SF_SMALL, multi=True).where("file_anio = 2025")
    silver_job.run(spark, BR.write_drifting_fixture(b, f"{root}/bronze"), f"{root}/silver", f"{root}/audit", "r1")
    got, want = _silver(spark, root), silver.clean(b)
    cols = want.columns
    assert got.count() == want.count() > 0 and got.select(cols).exceptAll(want).count() == 0


def test_rerun_empties_a_month_without_survivors(spark):
    """A corrected month of which no row survives leaves nothing of the first run, in silver and in the audit."""
    from helpers import SF_SMALL
    from ridelake.plans import silver_job
    from ridelake.sources import fixtures as FX
    root = scratch_path(spark, "rerun")
    b = FX.trips_bronze(spark, SF_SMALL).where("tipo_vehiculo = 'yellow'")
    run = lambda frame, name: silver_job.run(
        spark, {"yellow": BR.write_bronze_fixture(frame, f"{root}/{name}")["yellow"]}, f"{root}/silver", f"{root}/audit", name)
    first = {r.mes: (r.filas_entrada, r.filas_salida) for r in run(b, "r1").collect()}
    assert first[1][1] == _silver(spark, root).count() > 0
    second = {r.mes: (r.filas_entrada, r.filas_salida) for r in run(b.withColumn("fare_amount", F.lit(1000.0)), "r2").collect()}
    assert second == {m: (n, 0) for m, (n, _) in first.items()}
    assert _silver(spark, root).count() == 0
    run(b, "r3")
    assert _silver(spark, root).count() == first[1][1]


def test_rerun_leaves_months_it_did_not_read(spark):
    from helpers import SF_SMALL
    from ridelake.plans import silver_job
    from ridelake.sources import fixtures as FX
    root = scratch_path(spark, "rerun-part")
    b = FX.trips_bronze(spark, SF_SMALL, multi=True).where("tipo_vehiculo = 'fhv' AND file_anio = 2024")
    early, late = b.where("file_mes <= 6"), b.where("file_mes > 6")
    for name, frame in (("a", early), ("b", late)):
        audit = silver_job.run(spark, {"fhv": BR.write_bronze_fixture(frame, f"{root}/{name}")["fhv"]}, f"{root}/silver", f"{root}/audit", name)
        assert audit.agg(F.sum("filas_entrada")).first()[0] == frame.count()
    from ridelake.operators import silver
    assert _silver(spark, root).count() == silver.clean(b).count()


def test_csv_log_is_idempotent_and_ordered_by_time(spark):
    from ridelake.operators import quality as QL
    from ridelake.sources import audit_log as AL
    path = scratch_path(spark, "audit-csv")
    row = "tipo_vehiculo string, anio int, mes int, filas_entrada long, filas_salida long, pct_retenido double"
    for run, out in (("r9", 5), ("r10", 7), ("r10", 8)):  # r10 is retried
        AL.write_audit_csv(spark.createDataFrame([("yellow", 2024, 1, 10, out, out * 10.0)], row), path, run)
    log = AL.read_audit_csv(spark, path)
    assert log.count() == 2
    assert [(r.run_id, r.filas_salida) for r in QL.audit_latest(log).collect()] == [("r10", 8)]


def test_whole_table_write_drops_what_is_gone(spark):
    root = scratch_path(spark, "whole")
    WR.write_partitioned(spark.createDataFrame([(1, 2024), (2, 2025)], "v int, anio int"), root, ("anio",), whole=True)
    WR.write_partitioned(spark.createDataFrame([(3, 2025)], "v int, anio int"), root, ("anio",), whole=True)
    assert [(r.anio, r.v) for r in spark.read.parquet(root).collect()] == [(2025, 3)]


def test_ingest_listing_and_summary(spark):
    root = scratch_path(spark, "listing")
    for m in (1, 2):
        spark.range(m).write.parquet(f"{root}/green/green_tripdata_2025-{m:02d}.parquet")
    found = MF.existing_files(spark, [root])
    assert sorted((r.tipo_vehiculo, r.anio, r.mes) for r in found.collect()) == [("green", 2025, 1), ("green", 2025, 2)]
    results = spark.createDataFrame([("ok", 1.5), ("ok", 2.0), ("timeout", None)], "estado string, mb double")
    got = {r.estado: (r.archivos, r.total_mb) for r in MF.ingest_summary(results).collect()}
    assert got == {"ok": (2, 3.5), "skip": (0, 0.0), "not_found": (0, 0.0), "timeout": (1, 0.0), "error": (0, 0.0)}


def test_glob_scan_with_base_path(spark):
    root = scratch_path(spark, "glob")
    df = spark.range(4).select(F.col("id"), (F.col("id") % 2).alias("anio"))
    df.write.partitionBy("anio").parquet(root)
    got = spark.read.option("basePath", root).parquet(f"{root}/anio=1*").select("anio").distinct().collect()
    assert [r.anio for r in got] == [1]


def test_dynamic_overwrite_replaces_only_present_partitions(spark):
    root = scratch_path(spark, "dyn")
    a = spark.createDataFrame([(1, 2024), (2, 2025)], "v int, anio int")
    WR.write_partitioned(a, root, ("anio",))
    WR.write_partitioned(spark.createDataFrame([(3, 2025)], "v int, anio int"), root, ("anio",))
    got = sorted((r.anio, r.v) for r in spark.read.parquet(root).collect())
    assert got == [(2024, 1), (2025, 3)]


def test_zone_csv_keeps_na_text(spark):
    path = scratch_path(spark, "zones")
    df = spark.createDataFrame([(264, "Unknown", "N/A", "N/A")], ZN.ZONE_CSV_SCHEMA)
    ZN.write_zone_csv(df, path)
    r = ZN.read_zone_csv(spark, path).first()
    assert r.Zone == "N/A" and r.LocationID == 264


def test_manifest_month_table(spark):
    years = spark.createDataFrame([(2025,), (2026,)], "anio int")
    m = MF.expected_files(years)
    assert m.where("anio = 2025").count() == 48 and m.where("anio = 2026").count() == 20
    r = m.where("tipo_vehiculo = 'fhvhv' AND anio = 2026 AND mes = 5").first()
    assert r.archivo == "fhvhv_tripdata_2026-05.parquet"
    assert r.destino == "bronze/fhvhv/2026/fhvhv_tripdata_2026-05.parquet"


def test_silver_job_rerun_replaces_its_audit(spark):
    """Re-running a run id replaces that run's audit rows; another run id adds its own."""
    from ridelake.plans import silver_job
    from ridelake.queries import bronze_files
    from ridelake.sources import writers as WR
    from helpers import SF_SMALL
    folders = bronze_files(spark, SF_SMALL, False)
    root = scratch_path(spark, "silver-job-rerun")
    a1 = silver_job.run(spark, folders, f"{root}/silver", f"{root}/audit", "r1").count()
    silver_job.run(spark, folders, f"{root}/silver", f"{root}/audit", "r1")
    assert WR.read_audit(spark, f"{root}/audit").count() == a1
    silver_job.run(spark, folders, f"{root}/silver", f"{root}/audit", "r2")
    assert WR.read_audit(spark, f"{root}/audit").count() == 2 * a1


def test_file_without_month_in_path_reads_with_null_month(spark):
    """A bronze file whose name carries no month is read (NULL file month, so its rows fail the
    month rule and show in the audit) instead of failing the scan under ANSI casts."""
    from helpers import SF_SMALL
    from ridelake.sources import fixtures as FX
    root = scratch_path(spark, "bronze-nomonth")
    raw = FX.raw_frame(FX.trips_bronze(spark, SF_SMALL), "yellow").drop("trip_id", "file_anio", "file_mes")
    raw.limit(5).write.parquet(f"{root}/yellow/yellow_tripdata_unknown.parquet")
    df = BR.read_bronze(spark, f"{root}/yellow", "yellow")
    rows = df.select("file_anio", "file_mes").collect()
    assert len(rows) == 5 and all(r.file_anio is None and r.file_mes is None for r in rows)


def test_parts_of_one_month_may_differ(spark):
    root = scratch_path(spark, "parts")
    for i, typ in enumerate(("int", "double")):
        spark.range(2).select(F.lit(7).cast(typ).alias("PUlocationID")).write.parquet(f"{root}/fhv_tripdata_2024-01.parquet/{i}")
    df = BR.read_bronze(spark, root, "fhv")
    assert [(r.file_mes, r.PUlocationID) for r in df.collect()] == [(1, 7)] * 4


def test_files_that_arrow_cannot_open_are_inferred_by_spark(spark, monkeypatch):
    root = scratch_path(spark, "no-arrow")
    for month, typ in ((1, "int"), (2, "double"), (3, "int")):
        spark.range(1).select(F.lit(7).cast(typ).alias("PUlocationID")).write.parquet(f"{root}/fhv_tripdata_2024-{month:02d}.parquet")
    assert BR._physical_schema("nosuch://host/file.parquet") is None
    monkeypatch.setattr(BR, "_footers", lambda batches: (b.assign(esquema=None) for b in batches))
    assert len(BR.schema_groups(spark, {"fhv": [root]})["fhv"]) == 2
    assert sorted(r.file_mes for r in BR.read_bronze(spark, root, "fhv").collect()) == [1, 2, 3]


def test_a_job_killed_between_write_and_commit_changes_nothing(spark, monkeypatch):
    """The rows of the second run are stored but not committed: readers see the first run, whole."""
    import pytest
    from helpers import SF_SMALL
    from ridelake.plans import silver_job
    from ridelake.sources import fixtures as FX
    from ridelake.sources import silver_table as ST
    root = scratch_path(spark, "killed")
    b = FX.trips_bronze(spark, SF_SMALL, multi=True).where("tipo_vehiculo = 'green' AND file_anio = 2024")
    folders = [{"green": BR.write_bronze_fixture(f, f"{root}/{i}")["green"]}
               for i, f in enumerate((b, b.withColumn("fare_amount", F.col("fare_amount") + 1).where("file_mes <> 2")))]
    with monkeypatch.context() as m:  # killed in the very first run: no rows
        m.setattr(ST, "write_version", lambda *a, write=ST.write_version: write(*a) and 1 / 0)
        with pytest.raises(ZeroDivisionError):
            silver_job.run(spark, folders[0], f"{root}/silver", f"{root}/audit", "r0")
    assert _silver(spark, root).count() == 0
    silver_job.run(spark, folders[0], f"{root}/silver", f"{root}/audit", "r1")
    first = sorted(_silver(spark, root).collect(), key=str)
    with monkeypatch.context() as m:
        m.setattr(ST, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            silver_job.run(spark, folders[1], f"{root}/silver", f"{root}/audit", "r2")
    assert sorted(_silver(spark, root).collect(), key=str) == first != []
    silver_job.run(spark, folders[1], f"{root}/silver", f"{root}/audit", "r2")
    fares = lambda rows: sum(r.fare_amount for r in rows if r.mes != 2)
    now = _silver(spark, root).collect()
    assert fares(now) != fares(first) and [r for r in now if r.mes == 2] != []


def test_a_plain_folder_becomes_a_versioned_table(spark):
    from helpers import SF_SMALL
    from ridelake.operators import silver
    from ridelake.sources import fixtures as FX
    root = scratch_path(spark, "plain")
    s = silver.clean(FX.trips_bronze(spark, SF_SMALL, multi=True).where("tipo_vehiculo = 'fhv'"))
    WR.write_silver(s, f"{root}/silver")
    n = _silver(spark, root).count()
    WR.replace_silver(s.where("anio = 2024 AND mes = 1"), f"{root}/silver", [("fhv", 2024, 1)])
    assert _silver(spark, root).count() == n > 0
