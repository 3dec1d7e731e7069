"""Where checkpoints and scratch tables go."""

import pytest

from graphloom.session import scratch_path, shared_folder


class FakeContext:
    def __init__(self, master, named=None):
        self.master, self.named, self.folder = master, named, None

    def getConf(self):
        return {"spark.checkpoint.dir": self.named} if self.named else {}

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class FakeSession:
    def __init__(self, *args):
        self.sparkContext = FakeContext(*args)


def test_the_named_folder_is_used():
    assert shared_folder(FakeSession("yarn", "hdfs://x/ckpt/")) == "hdfs://x/ckpt"


def test_a_cluster_without_a_named_folder_is_refused():
    with pytest.raises(RuntimeError):
        shared_folder(FakeSession("yarn"))


def test_a_local_session_falls_back_once():
    session = FakeSession("local[4]")
    first = shared_folder(session)
    assert shared_folder(session) == first
    assert scratch_path(session, "a") != scratch_path(session, "a")
