"""Checkpoint-folder policy: read it from the session; a local fallback only for local masters."""

import pytest

from tq.session import checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, current=None, conf=None):
        self.master, self.current, self._conf = master, current, _Conf(conf or {})

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, path):
        self.current = path

    def getConf(self):
        return self._conf


class _Session:
    def __init__(self, master, current=None, conf=None, runtime=None):
        self.sparkContext = _Context(master, current, conf)
        self.conf = _Conf(runtime or {})


def test_existing_folder_is_used():
    assert checkpoint_dir(_Session("yarn", current="hdfs:///ckpt")) == "hdfs:///ckpt"


def test_configured_folder_is_applied():
    s = _Session("yarn", runtime={"spark.checkpoint.dir": "s3a://bucket/ckpt"})
    assert checkpoint_dir(s) == "s3a://bucket/ckpt"


def test_unset_folder_on_a_cluster_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(_Session("spark://host:7077"))


def test_unset_folder_locally_gets_a_fresh_temporary_folder():
    assert "tq-checkpoint-" in checkpoint_dir(_Session("local[2]"))
