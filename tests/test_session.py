import pytest

from tickloom.session import fresh_path, materialise, shared_dir


class Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" else default


class Cluster:
    """The two things ``shared_dir`` asks a session for."""

    def __init__(self, folder, master="yarn"):
        self.conf = Conf(folder)
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "app-1"})()


def test_the_named_folder_is_used():
    assert shared_dir(Cluster("hdfs://x/ckpt/")) == "hdfs://x/ckpt/tickloom-app-1"


def test_a_cluster_without_a_folder_is_an_error():
    with pytest.raises(RuntimeError):
        shared_dir(Cluster(None))


def test_materialise_cuts_lineage(spark):
    made = materialise(spark.range(10).withColumnRenamed("id", "x"), "t")
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "Range" not in plan and sorted(r.x for r in made.collect()) == list(range(10))
    assert fresh_path(spark, "a") != fresh_path(spark, "a")
