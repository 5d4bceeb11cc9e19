"""The shared folder."""

import pytest

from larder import session


class _Conf:
    def get(self, *_):
        return None


class _Context:
    master = "spark://host:7077"

    def getConf(self):
        return _Conf()

    def getCheckpointDir(self):
        return None


class _Session:
    conf, sparkContext = _Conf(), _Context()


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(_Session())


def test_shared_folder_is_stable(spark):
    assert session.shared_dir(spark) == session.shared_dir(spark)
