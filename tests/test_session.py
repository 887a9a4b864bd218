"""Session helpers: shared checkpoint folder rules, group-limit threshold."""

import pytest

from tuplecohort.session import GROUP_LIMIT_CONF, checkpoint_dir, ensure_group_limit


class _Conf:
    def __init__(self, values):
        self.values = dict(values)

    def get(self, key, default=None):
        return self.values.get(key, default)

    def set(self, key, value):
        self.values[key] = value


class _Context:
    def __init__(self, master, ckpt=None):
        self.master, self.ckpt = master, ckpt

    def getCheckpointDir(self):
        return self.ckpt

    def setCheckpointDir(self, d):
        self.ckpt = d


class _Session:
    def __init__(self, master, conf=None, ckpt=None):
        self.sparkContext = _Context(master, ckpt)
        self.conf = _Conf(conf or {})


def test_cluster_without_shared_folder_refuses_local_temp():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(_Session("yarn"))


def test_cluster_uses_the_configured_folder():
    s = _Session("spark://host:7077", conf={"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert checkpoint_dir(s) == "hdfs:///shared/ckpt"
    assert s.sparkContext.getCheckpointDir() == "hdfs:///shared/ckpt"


def test_local_session_gets_a_scratch_folder():
    s = _Session("local[2]")
    d = checkpoint_dir(s)
    assert d and checkpoint_dir(s) == d


def test_group_limit_threshold_only_raised():
    s = _Session("local[2]", conf={GROUP_LIMIT_CONF: "1000"})
    ensure_group_limit(s, 4096)
    assert int(s.conf.get(GROUP_LIMIT_CONF)) >= 4098
    s.conf.set(GROUP_LIMIT_CONF, "1000000")
    ensure_group_limit(s, 4096)
    assert s.conf.get(GROUP_LIMIT_CONF) == "1000000"


def test_fanout_follows_the_larger_initial_partition_count():
    from tuplecohort.operators.bottomk import auto_fanout
    assert auto_fanout(_Session("local", conf={"spark.sql.shuffle.partitions": "200"}), 4096) == 1
    assert auto_fanout(_Session("local", conf={
        "spark.sql.shuffle.partitions": "200",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4096"}), 4096) == 9
    assert auto_fanout(_Session("local", conf={"spark.sql.shuffle.partitions": "20000"}), 4096) == 41  # 20000 * 4098 / 2,000,000
