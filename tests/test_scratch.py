import pytest

from gaugeframe.plans.scratch import scratch_path


class Conf(dict):
    def get(self, key, default=None):
        return super().get(key, default)


class Session:
    def __init__(self, **conf):
        self.conf = Conf({k.replace("_", "."): v for k, v in conf.items()})


def test_shared_folder_of_the_session_is_used():
    session = Session(spark_checkpoint_dir="hdfs://nn/ckpt/", spark_master="yarn")
    first, second = scratch_path(session, "x"), scratch_path(session, "x")
    assert first.startswith("hdfs://nn/ckpt/x-") and first != second


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError):
        scratch_path(Session(spark_master="spark://host:7077"), "x")
    assert "gaugeframe-" in scratch_path(Session(spark_master="local[8]"), "x")
