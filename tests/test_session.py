from types import SimpleNamespace

import pytest

from sluicework.session import scratch_path, scratch_root


class Conf:
    def __init__(self, value=None):
        self.value = value

    def get(self, key, default=None):
        assert key == "spark.checkpoint.dir"
        return self.value or default


def session(master, folder=None, app="app-1"):
    return SimpleNamespace(
        conf=Conf(folder), sparkContext=SimpleNamespace(master=master, applicationId=app)
    )


def test_the_folder_is_the_one_the_cluster_names():
    assert scratch_root(session("yarn", "hdfs://shared/checkpoints/")) == "hdfs://shared/checkpoints"
    first, second = (scratch_path(session("yarn", "hdfs://shared"), "t") for _ in range(2))
    assert first.startswith("hdfs://shared/sluicework/t-") and first != second


def test_a_cluster_without_the_setting_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(session("yarn"))


def test_a_local_session_gets_one_folder_of_its_own():
    assert scratch_root(session("local[4]")) == scratch_root(session("local[4]"))
    assert scratch_root(session("local[4]", app="app-2")) != scratch_root(session("local[4]"))
