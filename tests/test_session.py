"""Session sizing: submitted settings win; cluster sizing only on a cluster."""

from ridelake.session import session_conf


def test_local_session_gets_engine_defaults_only():
    c = session_conf("local[8]", {}, shuffle_partitions=8)
    assert c["spark.sql.adaptive.enabled"] == "true"
    assert c["spark.sql.shuffle.partitions"] == "8"
    assert "spark.sql.files.maxPartitionBytes" not in c


def test_cluster_session_sized_and_submit_conf_wins():
    submitted = {"spark.master": "yarn", "spark.sql.files.maxPartitionBytes": "512m"}
    c = session_conf(None, submitted)
    assert "spark.sql.files.maxPartitionBytes" not in c  # submitted value is kept
    assert c["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == "256m"
    assert c["spark.decommission.enabled"] == "true"


class _Conf(dict):
    def get(self, k, default=None):
        return super().get(k, default)


class _SC:
    def __init__(self, master, ckpt=None):
        self.master, self._ckpt = master, ckpt

    def getCheckpointDir(self):
        return self._ckpt

    def setCheckpointDir(self, d):
        self._ckpt = d


class _Spark:
    def __init__(self, master, conf=None, ckpt=None):
        self.sparkContext = _SC(master, ckpt)
        self.conf = _Conf(conf or {})


def test_cluster_without_shared_checkpoint_folder_fails():
    import pytest

    from ridelake.session import checkpoint_root
    with pytest.raises(RuntimeError):
        checkpoint_root(_Spark("yarn"))


def test_checkpoint_folder_read_from_session():
    from ridelake.session import checkpoint_root, scratch_path
    assert checkpoint_root(_Spark("yarn", ckpt="hdfs://nn/ckpt/app")) == "hdfs://nn/ckpt/app"
    s = _Spark("k8s://x", conf={"spark.checkpoint.dir": "hdfs://shared/ckpt"})
    assert checkpoint_root(s) == "hdfs://shared/ckpt"
    assert scratch_path(s, "gold").startswith("hdfs://shared/ckpt/gold-")
