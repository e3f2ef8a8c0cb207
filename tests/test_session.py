import pytest

from stratafold import session


class FakeSession:
    def __init__(self, **conf):
        self.conf = {key.replace("_", "."): value for key, value in conf.items()}


def test_the_shared_folder_is_the_one_the_cluster_names():
    assert session.shared_folder(FakeSession(spark_checkpoint_dir="hdfs:///c/")) == "hdfs:///c"


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(FakeSession(spark_master="yarn"))
    assert session.shared_folder(FakeSession(spark_master="local[4]")).endswith("stratafold")


def test_folders_are_never_reused(spark):
    assert session.new_folder(spark, "x") != session.new_folder(spark, "x")
