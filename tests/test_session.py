"""Checkpoint folder: the session's setting wins; set one only where unset."""

import pytest

from panelmerge.session import ensure_checkpoint_dir


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" and self.value else default

    def set(self, key, value):  # a running session rejects this key
        raise AssertionError("must not set spark.checkpoint.dir at runtime")


class _Ctx:
    def __init__(self):
        self.dir = None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, d):
        self.dir = "file:" + d


class _Session:
    def __init__(self, value):
        self.conf, self.sparkContext = _Conf(value), _Ctx()


def test_uses_cluster_setting():
    s = _Session("hdfs://shared/ckpt")
    assert ensure_checkpoint_dir(s) == "hdfs://shared/ckpt" and s.sparkContext.dir is None


def test_registers_scratch_only_when_unset():
    s = _Session(None)
    d = ensure_checkpoint_dir(s)
    assert d.startswith("file:") and s.sparkContext.dir == d
    assert ensure_checkpoint_dir(s) == d


def test_no_local_scratch_on_a_cluster():
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        s = _Session(None)
        s.sparkContext.master = master
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            ensure_checkpoint_dir(s)


def test_session_defaults(spark):
    conf = spark.conf
    assert conf.get("spark.sql.adaptive.enabled") == "true"
    assert conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
    assert conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.sparkContext.getConf().get("spark.ui.enabled") == "false"
