"""Shared-folder rules: never a machine-local temp folder on a cluster."""

import tempfile

import pytest

from roomstar.session import checkpoint_dir, submitted


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, values):
        self.master, self._dir, self._conf = master, None, _Conf(values)

    def getCheckpointDir(self):
        return self._dir

    def setCheckpointDir(self, d):
        self._dir = d

    def getConf(self):
        return self._conf


class _Session:
    def __init__(self, master, values=None):
        self.sparkContext = _Context(master, values or {})
        self.conf = _Conf(values or {})


def test_cluster_without_shared_folder_fails():
    with pytest.raises(RuntimeError):
        checkpoint_dir(_Session("yarn"))


def test_cluster_uses_the_named_folder():
    s = _Session("spark://head:7077", {"spark.checkpoint.dir": "hdfs:///shared/ck"})
    assert checkpoint_dir(s) == "hdfs:///shared/ck"


def test_local_without_folder_gets_a_temp_one():
    assert checkpoint_dir(_Session("local[2]")).startswith(tempfile.gettempdir())


def test_submitted_settings_are_kept(monkeypatch):
    monkeypatch.setenv("PYSPARK_SUBMIT_ARGS", "--conf spark.sql.shuffle.partitions=777 pyspark-shell")
    assert submitted("spark.sql.shuffle.partitions") and not submitted("spark.driver.memory")
