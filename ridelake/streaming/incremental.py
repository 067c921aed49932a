"""Incremental bronze → silver with Structured Streaming.

Replaces a driver loop over type × year × month with its "folder is
non-empty" resume test: the file source's checkpoint records which bronze
files were processed, so a re-run picks up only new files, and a failed
batch is replayed from the checkpoint (exactly-once with idempotent sinks).
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import SILVER_PARTITIONS, VEHICLE_TYPES
from ..operators import conform as CF
from ..operators import silver as SV
from ..sources import silver_table as ST
from ..sources.bronze import FILE_COLUMNS, read_bronze_types, rows_per_month


# Upper bound on the bronze bytes one type's file stream takes into a micro-batch.
# A backlog (first run, or a long pause) is then processed as a sequence of
# bounded batches, each committed on its own, instead of one batch holding
# every new file; a failed batch replays only its own files.
DEFAULT_BATCH_BYTES = 256 * 1024 ** 3


_LISTING = "path string, modificationTime timestamp, length long, content binary"


def arrivals(spark: SparkSession, folders: dict[str, str], max_files_per_trigger: int | None = None,
             max_bytes_per_trigger: int = DEFAULT_BATCH_BYTES) -> DataFrame:
    """Stream of the bronze files that arrive (``tipo_vehiculo``, ``path``), one file stream per type.

    Only the listing is streamed; each batch then reads its files with the batch
    reader, which takes months of differing physical types. Micro-batches are bounded by
    ``max_files_per_trigger`` when given, else by ``max_bytes_per_trigger`` (Spark takes one or the other).
    """
    parts = []
    for tipo in VEHICLE_TYPES:
        if tipo not in folders:
            continue
        r = (spark.readStream.format("binaryFile").schema(_LISTING).option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.parquet"))
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        else:
            r = r.option("maxBytesPerTrigger", int(max_bytes_per_trigger))
        parts.append(r.load(folders[tipo]).select(F.lit(tipo).alias("tipo_vehiculo"), "path"))
    return reduce(lambda a, b: a.unionByName(b), parts)


def _write_batch(silver_path: str, audit_path: str, checkpoint: str):
    def write(arrived: DataFrame, batch_id: int) -> None:
        files: dict[str, list[str]] = {}
        for r in arrived.collect():  # file names of one bounded batch
            files.setdefault(r["tipo_vehiculo"], []).append(r["path"])
        if not files:
            return
        spark = arrived.sparkSession
        # The stream's id lives in its checkpoint: a new checkpoint is a new stream, whose batches count anew.
        stream = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        if ST.is_committed(spark, silver_path, stream, batch_id):
            return
        # A batch is a version of its own, written anew by a replay; no reader sees it before the commit, which
        # puts it beside what its months hold (a month split over several files keeps all parts).
        version = ST.batch_version(stream, batch_id)
        batch = CF.conform_all(read_bronze_types(spark, files), keep=FILE_COLUMNS)
        months = ST.write_version(SV.clean(batch), silver_path, version)
        # The batch is not persisted: the write is its only data pass, and the audit
        # counts rows from the batch files' footers and the partitions this batch wrote.
        written = ST.read_version(spark, silver_path, version).select(*SILVER_PARTITIONS)
        # Audit rows keyed by batch id: a replayed batch overwrites its own rows instead of adding.
        (SV.audit_of_counts(rows_per_month(spark, files), written).withColumn("batch_id", F.lit(batch_id))
           .withColumn("run_ts", F.current_timestamp())
           .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy("batch_id").parquet(audit_path))
        ST.add_batch(spark, silver_path, stream, batch_id, months)
    return write


def run_incremental(spark: SparkSession, folders: dict[str, str], silver_path: str, audit_path: str,
                    checkpoint: str, max_files_per_trigger: int | None = None,
                    max_bytes_per_trigger: int = DEFAULT_BATCH_BYTES) -> None:
    """Process every bronze file not yet seen in bounded batches, then stop (``availableNow``)."""
    q = (arrivals(spark, folders, max_files_per_trigger, max_bytes_per_trigger).writeStream
         .foreachBatch(_write_batch(silver_path, audit_path, checkpoint))
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
