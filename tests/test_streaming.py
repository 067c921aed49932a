"""The incremental stream equals the batch result and never reprocesses a file."""

from helpers import SF_SMALL
from pyspark.sql import functions as F

from ridelake.contracts import SILVER_COLUMNS
from ridelake.operators import silver
from ridelake.session import scratch_path
from ridelake.sources import bronze as BR
from ridelake.sources import fixtures as FX
from ridelake.sources import silver_table as ST
from ridelake.streaming import incremental as INC


def test_incremental_equals_batch_and_is_idempotent(spark):
    root = scratch_path(spark, "stream")
    b = FX.trips_bronze(spark, SF_SMALL, multi=True)
    first = b.where(F.col("file_anio") <= 2024)
    later = b.where(F.col("file_anio") > 2024)
    folders = BR.write_bronze_fixture(first, f"{root}/bronze")
    args = (folders, f"{root}/silver", f"{root}/audit", f"{root}/_ckpt")
    INC.run_incremental(spark, *args, max_files_per_trigger=5)
    n1 = ST.read_silver(spark, f"{root}/silver").count()
    INC.run_incremental(spark, *args)  # nothing new: no batch, nothing added
    assert ST.read_silver(spark, f"{root}/silver").count() == n1
    batches = spark.read.parquet(f"{root}/audit").select("batch_id").distinct().count()
    BR.write_bronze_fixture(later, f"{root}/bronze_new")
    for t in folders:  # new month files arrive in the watched folders
        spark.read.parquet(f"{root}/bronze_new/{t}").write.mode("append").partitionBy("archivo") \
             .parquet(folders[t])
    INC.run_incremental(spark, *args)
    got = ST.read_silver(spark, f"{root}/silver").select(*SILVER_COLUMNS)
    want = silver.clean(b)
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0
    assert spark.read.parquet(f"{root}/audit").select("batch_id").distinct().count() > batches
    audit_in = spark.read.parquet(f"{root}/audit").agg(F.sum("filas_entrada")).first()[0]
    assert audit_in == b.count()


def test_month_split_over_batches_keeps_both_parts(spark):
    root = scratch_path(spark, "stream-split")
    b = FX.trips_bronze(spark, SF_SMALL).where(F.col("file_mes") == 1)
    folder = f"{root}/bronze/yellow"
    y = FX.raw_frame(b, "yellow")
    part1, part2 = y.where(F.col("trip_id") % 2 == 0), y.where(F.col("trip_id") % 2 == 1)
    part1.drop("file_anio", "file_mes").coalesce(1).write.parquet(f"{folder}/yellow_tripdata_2024-01.parquet/a")
    args = ({"yellow": folder}, f"{root}/silver", f"{root}/audit", f"{root}/_ckpt")
    INC.run_incremental(spark, *args)
    part2.drop("file_anio", "file_mes").coalesce(1).write.parquet(f"{folder}/yellow_tripdata_2024-01.parquet/b")
    INC.run_incremental(spark, *args)
    got = ST.read_silver(spark, f"{root}/silver").count()
    assert got == silver.clean(b.where(F.col("tipo_vehiculo") == "yellow")).count()


def test_byte_bounded_batches_equal_batch_result(spark):
    """A backlog split into many byte-bounded micro-batches gives the batch result and a full audit."""
    root = scratch_path(spark, "stream-bytes")
    b = FX.trips_bronze(spark, SF_SMALL, multi=True).where(F.col("file_anio") == 2024)
    folders = BR.write_bronze_fixture(b, f"{root}/bronze")
    INC.run_incremental(spark, folders, f"{root}/silver", f"{root}/audit", f"{root}/_ckpt",
                        max_bytes_per_trigger=1)  # every micro-batch takes a single file
    audit = spark.read.parquet(f"{root}/audit")
    assert audit.select("batch_id").distinct().count() > 4
    got = ST.read_silver(spark, f"{root}/silver").select(*SILVER_COLUMNS)
    want = silver.clean(b)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
    tot = audit.agg(F.sum("filas_entrada"), F.sum("filas_salida")).first()
    assert tot[0] == b.count() and tot[1] == want.count()


def test_drifting_files_stream(spark):
    """Months whose physical types differ arrive in one stream."""
    root = scratch_path(spark, "stream-drift")
    b = FX.trips_bronze(spark, SF_SMALL, multi=True).where("file_anio = 2024 AND tipo_vehiculo IN ('yellow', 'green')")
    folders = {t: p for t, p in BR.write_drifting_fixture(b, f"{root}/bronze").items() if t in ("yellow", "green")}
    INC.run_incremental(spark, folders, f"{root}/silver", f"{root}/audit", f"{root}/_ckpt")
    got, want = ST.read_silver(spark, f"{root}/silver").select(*SILVER_COLUMNS), silver.clean(b)
    assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0


def test_replayed_batch_adds_nothing(spark):
    """A batch that was committed but not recorded by the stream is run again: the table stays as it is, compacted or not."""
    root = scratch_path(spark, "stream-replay")
    b = FX.trips_bronze(spark, SF_SMALL).where("tipo_vehiculo = 'green'")
    folders = {"green": BR.write_bronze_fixture(b, f"{root}/bronze")["green"]}
    args = (folders, f"{root}/silver", f"{root}/audit", f"{root}/_ckpt")
    INC.run_incremental(spark, *args)
    n = ST.read_silver(spark, f"{root}/silver").count()
    arrived = BR._listing(spark, {"green": [folders["green"]]})
    replay = INC._write_batch(f"{root}/silver", f"{root}/audit", f"{root}/_ckpt")
    replay(arrived, 0)
    assert ST.read_silver(spark, f"{root}/silver").count() == n > 0


def test_batch_and_stream_share_the_table(spark):
    """The stream adds a month's second part, the compaction folds both, the batch job replaces the month at once."""
    from ridelake.plans import silver_job
    root = scratch_path(spark, "one-table")
    b = FX.trips_bronze(spark, SF_SMALL).where("tipo_vehiculo = 'yellow' AND file_mes = 1")
    folder, path = f"{root}/bronze/yellow", f"{root}/silver"
    y = FX.raw_frame(b, "yellow")
    for i, part in enumerate("ab"):
        (y.where(F.col("trip_id") % 2 == i).drop("file_anio", "file_mes").coalesce(1)
         .write.parquet(f"{folder}/yellow_tripdata_2024-01.parquet/{part}"))
        INC.run_incremental(spark, {"yellow": folder}, path, f"{root}/audit", f"{root}/_ckpt")
    want = silver.clean(b)
    same = lambda: (lambda got: got.count() == want.count() and got.exceptAll(want).count() == 0)(
        ST.read_silver(spark, path).select(*SILVER_COLUMNS))
    assert same() and [len(v) for v in ST.pointer(spark, path).months.values()] == [2]
    assert ST.compact_silver(spark, path) == [("yellow", 2024, 1)] and same()
    assert ST.compact_silver(spark, path) == []
    assert len(ST.vacuum_silver(spark, path)) == 2 and same()
    silver_job.run(spark, {"yellow": folder}, path, f"{root}/audit-batch", "r1")
    assert same() and [len(v) for v in ST.pointer(spark, path).months.values()] == [1]
