import os

import pytest

from tidemark.sources import scratch


class Context:
    def __init__(self, master, folder=None):
        self.master, self.folder, self.applicationId = master, folder, f"app-{master}"

    def getConf(self):
        return {}

    def getCheckpointDir(self):
        return self.folder


class Session:
    def __init__(self, master, folder=None, named=None):
        self.sparkContext, self.conf = Context(master, folder), {"spark.checkpoint.dir": named}


def test_folder():
    assert scratch.shared_dir(Session("yarn", named="hdfs://x/c/")) == "hdfs://x/c"
    assert scratch.shared_dir(Session("yarn", folder="hdfs://x/d")) == "hdfs://x/d"
    assert scratch.shared_dir(Session("local[4]")).startswith("file:///")
    with pytest.raises(RuntimeError, match="checkpoint"):
        scratch.shared_dir(Session("spark://host:7077"))


def test_tables_go(spark):
    box = scratch.Scratch(spark, "t")
    table, path = box.stored(spark.range(3), "numbers")
    assert table.count() == 3
    box.drop(path)
    assert not os.path.exists(path.removeprefix("file://"))
    box.table(spark.range(2), "more")
    base = box.base.removeprefix("file://")
    assert os.path.exists(base)
    scratch.clear(spark)
    assert not os.path.exists(base)
