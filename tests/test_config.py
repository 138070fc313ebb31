"""Scratch-folder rules and the cluster preset (no Spark needed)."""

from __future__ import annotations

import pytest

from meterlake import config


class _Conf:
    def __init__(self, values):
        self.values = dict(values)

    def get(self, key, default=None):
        return self.values.get(key, default)

    def set(self, key, value):
        self.values[key] = value


class _Context:
    def __init__(self, master, ckpt=None):
        self.master = master
        self.ckpt = ckpt

    def getCheckpointDir(self):
        return self.ckpt

    def setCheckpointDir(self, path):
        self.ckpt = path


class _Session:
    def __init__(self, master, conf=None, ckpt=None):
        self.conf = _Conf(conf or {})
        self.sparkContext = _Context(master, ckpt)


def test_shared_dir_uses_the_cluster_setting():
    s = _Session("spark://cluster:7077", {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    path = config.shared_dir(s, "fact")
    assert path.startswith("hdfs:///shared/ckpt/meterlake/fact/")
    assert config.shared_dir(s, "fact") != path  # a fresh folder per call


def test_cluster_without_setting_refuses_a_local_folder():
    with pytest.raises(RuntimeError):
        config.shared_dir(_Session("yarn"), "fact")


def test_local_without_setting_registers_a_private_folder():
    s = _Session("local[4]")
    path = config.shared_dir(s, "x", unique=False)
    assert s.sparkContext.ckpt and path.startswith(s.sparkContext.ckpt)
    assert s.conf.get("spark.checkpoint.dir") == s.sparkContext.ckpt


def test_cluster_preset_starts_wide_and_coalesces_by_size():
    conf = config.cluster_conf(8000)
    assert int(conf["spark.sql.adaptive.coalescePartitions.initialPartitionNum"]) >= 32000
    assert conf["spark.sql.adaptive.coalescePartitions.parallelismFirst"] == "false"
    assert conf["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == "128m"
