"""The stored silver table (K1, T1): version folders and a pointer, shared by batch and stream.

Rows lie in ``version=<v>/tipo_vehiculo=…/anio=…/mes=…``; a version is never
changed once it is committed. The pointer is a small Parquet log: its last row
names the versions of each month. Appending that row is one file put in
place, so readers see the table before or after a change, never between. One
writer at a time; any number of readers. A folder in the plain layout
(no pointer) is read as it is, and its months stay when the first version is committed.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import SILVER_PARTITIONS, SILVER_SCHEMA

Month = tuple[str, int, int]  # type, year, month

_POINTER_SCHEMA = ("secuencia long, lotes map<string, long>, "
                   "meses array<struct<tipo_vehiculo: string, anio: int, mes: int, versiones: array<string>>>")
PLAIN = ""  # the version of months that lie in the table folder itself


@dataclass(frozen=True)
class Pointer:
    """What the table holds: the versions of each month, and the last batch of each stream."""

    sequence: int = 0
    months: dict[Month, tuple[str, ...]] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)


def _missing(e: AnalysisException) -> bool:
    return e.getCondition() == "PATH_NOT_FOUND"


def silver_files(spark: SparkSession, path: str) -> DataFrame:
    """Path and month of every silver file below ``path``; a listing, no file is opened. Empty where nothing is stored yet."""
    try:
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
                 .load(path).select("path"))
    except AnalysisException as e:
        if not _missing(e):
            raise
        return spark.createDataFrame([], "path string, tipo_vehiculo string, anio int, mes int")
    part = lambda name: F.regexp_extract("path", f"/{name}=([^/]+)/", 1)
    return files.select("path", part("tipo_vehiculo").alias("tipo_vehiculo"), part("anio").cast("int").alias("anio"),
                        part("mes").cast("int").alias("mes"))


def _stored_months(spark: SparkSession, path: str) -> list[Month]:
    return [tuple(r) for r in silver_files(spark, path).select(*SILVER_PARTITIONS).distinct().collect()]  # months: a few


def pointer(spark: SparkSession, path: str) -> Pointer | None:
    """The last committed pointer, or None for a table that never had one."""
    try:
        last = (spark.read.schema(_POINTER_SCHEMA).parquet(f"{path}/_pointer/log")
                .orderBy(F.desc("secuencia")).first())
    except AnalysisException as e:
        if not _missing(e):
            raise
        return None
    if last is None:
        return None
    months = {(m["tipo_vehiculo"], m["anio"], m["mes"]): tuple(m["versiones"]) for m in last["meses"]}
    return Pointer(last["secuencia"], months, dict(last["lotes"]))


def commit(spark: SparkSession, path: str, new: Pointer) -> None:
    """Make ``new`` what readers see: one row, one file."""
    row = (new.sequence, new.batches, [(*m, list(v)) for m, v in sorted(new.months.items())])
    spark.createDataFrame([row], _POINTER_SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/_pointer/log")


def opened(spark: SparkSession, path: str) -> Pointer:
    """The last pointer; a table without one gets its first, which names the months of the plain layout.

    So a pointer is there before any version folder, and what a killed first run leaves is never read.
    """
    now = pointer(spark, path)
    if now is None:
        now = Pointer(months={m: (PLAIN,) for m in _stored_months(spark, path)})
        commit(spark, path, now)
    return now


def _folder(path: str, version: str) -> str:
    return f"{path}/version={version}" if version else path


def write_version(silver: DataFrame, path: str, version: str) -> list[Month]:
    """Write rows as a version of an opened table that no reader sees yet; returns its months.

    No repartition before the write: bronze splits map to one month each, so every task
    writes into one or few folders, and a shuffle by month would put a
    whole one (possibly a third of all rows) into a single task.
    """
    folder = _folder(path, version)
    (silver.write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy(*SILVER_PARTITIONS).parquet(folder))
    return _stored_months(silver.sparkSession, folder)


def _read(spark: SparkSession, path: str, months: dict[Month, tuple[str, ...]]) -> DataFrame:
    columns = SILVER_SCHEMA.fieldNames()
    plain, versioned = [], []
    for month, versions in months.items():
        place = "/".join(f"{k}={v}" for k, v in zip(SILVER_PARTITIONS, month))
        for v in versions:
            (versioned if v else plain).append(f"{_folder(path, v)}/{place}")
    reader = spark.read.schema(SILVER_SCHEMA).option("basePath", path)
    parts = [reader.parquet(*p).select(*columns) for p in (plain, versioned) if p]
    return reduce(lambda a, b: a.unionByName(b), parts) if parts else spark.createDataFrame([], SILVER_SCHEMA)


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """The committed rows with their declared schema (month columns included); no rows where every month is empty."""
    now = pointer(spark, path)
    if now is None:
        return spark.read.schema(SILVER_SCHEMA).parquet(path)
    return _read(spark, path, now.months)


def read_version(spark: SparkSession, path: str, version: str) -> DataFrame:
    """The rows of one version, committed or not."""
    return spark.read.schema(SILVER_SCHEMA).parquet(_folder(path, version))


def replace_silver(silver: DataFrame, path: str, months: list[Month]) -> str:
    """K1 for a run that has read all of ``months``: each is replaced, all of them at once.

    A month of which no row survives leaves the table. Returns the version written.
    """
    spark = silver.sparkSession
    old, version = opened(spark, path), uuid.uuid4().hex
    written = write_version(silver, path, version)
    kept = {m: v for m, v in old.months.items() if m not in set(months)}
    commit(spark, path, Pointer(old.sequence + 1, kept | {m: (version,) for m in written}, old.batches))
    return version


def batch_version(stream: str, batch_id: int) -> str:
    return f"{stream}-{batch_id}"


def is_committed(spark: SparkSession, path: str, stream: str, batch_id: int) -> bool:
    """Whether this batch of the stream is in the table already (a replay after its commit)."""
    return batch_id <= opened(spark, path).batches.get(stream, -1)


def add_batch(spark: SparkSession, path: str, stream: str, batch_id: int, written: list[Month]) -> None:
    """Commit a batch's version beside what its months already hold."""
    old, version = opened(spark, path), batch_version(stream, batch_id)
    months = dict(old.months)
    for m in written:
        months[m] = (*months.get(m, ()), version)
    commit(spark, path, Pointer(old.sequence + 1, months, old.batches | {stream: batch_id}))


def compact_silver(spark: SparkSession, path: str) -> list[Month]:
    """Fold every month that lies in several versions into one; rows stay as they are. Returns the months.

    Only those months are read. The rebalance sizes their files and splits a hot month over tasks.
    """
    old = opened(spark, path)
    spread = {m: v for m, v in old.months.items() if len(v) > 1}
    if not spread:
        return []
    version = uuid.uuid4().hex
    written = write_version(_read(spark, path, spread).hint("rebalance", *SILVER_PARTITIONS), path, version)
    commit(spark, path, Pointer(old.sequence + 1, old.months | {m: (version,) for m in written}, old.batches))
    return sorted(spread)


def vacuum_silver(spark: SparkSession, path: str) -> list[str]:
    """Delete the versions that the pointer no longer names; returns them. For times when no older reader or writer is at work."""
    now = pointer(spark, path)
    if now is None:
        return []
    live = {v for versions in now.months.values() for v in versions}
    name = F.regexp_extract("path", "/version=([^/]+)/", 1)
    stored = [r[0] for r in silver_files(spark, path).select(name).distinct().collect()]
    gone = sorted(v for v in stored if v and v not in live)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for v in gone:
        folder = jvm.org.apache.hadoop.fs.Path(_folder(path, v))
        folder.getFileSystem(conf).delete(folder, True)
    return gone
