"""Session construction and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


# Engine defaults for every session (applied only where the submit configuration
# leaves them unset).
SESSION_DEFAULTS = {
    # Wall-clock semantics: trip timestamps are read as timestamp_ntz.
    "spark.sql.session.timeZone": "America/New_York",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Partitioned writes keep up to 4 files open per task instead of sorting every
    # task's rows by the partition columns first: a bronze split comes from one
    # month file, so a silver write task has one partition and the planned sort
    # (a full per-task sort at any scale) is dropped; a task that meets more
    # partitions than this falls back to sorting the rest.
    "spark.sql.maxConcurrentOutputFileWriters": "4",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Sizing for a large cluster (~100 TB of trips, ~1000 executors). Scans: 256 MB
# splits (400k tasks per 100 TB instead of 800k at 128 MB, each still far below
# executor memory). Shuffles start wide and AQE coalesces them to ~256 MB
# partitions, so the gold aggregations (which shuffle groups, not trips) and any
# large join get partitions that fit in memory at any scale without a
# hand-tuned partition count. Decommissioning moves shuffle and cached blocks off
# executors that are being taken away, so lost executors cost little recompute.
CLUSTER_DEFAULTS = {
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8192",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.shuffle.partitions": "8192",
    "spark.decommission.enabled": "true",
    "spark.storage.decommission.enabled": "true",
    "spark.storage.decommission.shuffleBlocks.enabled": "true",
    "spark.storage.decommission.rddBlocks.enabled": "true",
}


def session_conf(master: str | None, submitted: dict[str, str],
                 shuffle_partitions: int | None = None) -> dict[str, str]:
    """The settings ``build_session`` adds: defaults not already in ``submitted``."""
    local = (master or submitted.get("spark.master", "local")).startswith("local")
    wanted = dict(SESSION_DEFAULTS)
    if not local:
        wanted.update(CLUSTER_DEFAULTS)
    if shuffle_partitions:
        wanted["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    return {k: v for k, v in wanted.items() if k not in submitted}


def build_session(master: str | None = None, app: str = "ridelake",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """A session tuned for the trip jobs.

    On a cluster the master, memory and checkpoint folder come from the
    submit configuration, which always wins; only the defaults above that it
    leaves unset are added.
    """
    from pyspark import SparkConf
    submitted = dict(SparkConf().getAll())  # spark-submit --conf / spark-defaults values
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in session_conf(master, submitted, shuffle_partitions).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def session_key(spark: SparkSession) -> str:
    """Identifier of the running application (classic or Connect sessions)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - Connect sessions expose no SparkContext
        return spark.conf.get("spark.app.id", None) or str(id(spark))


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    It is read from the session. Only a local session without one gets its
    own folder (tests, single-machine runs); a cluster session must name a
    shared folder, since executors may be lost and a machine-local folder
    would vanish with them.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect: the server owns the checkpoint folder
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = (sc.master if sc is not None else spark.conf.get("spark.master", "")) or ""
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        if sc is None:
            raise RuntimeError("with Spark Connect spark.checkpoint.dir must name a folder that the server shares")
        root = tempfile.mkdtemp(prefix="ridelake-ckpt-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)  # this process's own folder, gone with it
    if sc is None:
        return root
    sc.setCheckpointDir(root)
    # setCheckpointDir adds a random sub-folder; use what Spark reports.
    return sc.getCheckpointDir() or root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the checkpoint root for one job's output."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"
