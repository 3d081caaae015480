"""The shared folder: named, or temporary in local mode alone."""

import pytest

from brindle.functions import shared


class Conf(dict):
    def set(self, k, v):
        self[k] = v


class Fake:
    def __init__(self, master, **conf):
        self.conf = Conf(conf)
        self.sparkContext = self
        self.master = master

    def getConf(self):
        return {}


def test_folder():
    assert shared.folder(Fake("yarn", **{"spark.checkpoint.dir": "hdfs:///x/"})) == "hdfs:///x"
    local = Fake("local[4]")
    assert shared.folder(local) == shared.folder(local)
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            shared.folder(Fake(master))
