import os

import pytest

from tokenloom import session


class Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        assert key == "spark.checkpoint.dir"
        return self.value or default


class Fake:
    """A session as the folder choice sees it."""

    def __init__(self, named, master):
        self.conf = Conf(named)
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "app-of-this-test"})


def test_the_named_folder_is_used():
    assert session.shared_dir(Fake("hdfs://shared/work/", "yarn")) == "hdfs://shared/work"
    assert session.scratch_path(Fake("hdfs://shared/work/", "yarn"), "x").startswith("hdfs://shared/work/x-")


def test_a_cluster_must_name_a_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Fake(None, "spark://host:7077"))


def test_a_local_session_gets_one_temporary_folder():
    folder = session.shared_dir(Fake(None, "local[2]"))
    assert os.path.isdir(folder) and session.shared_dir(Fake("", "local[2]")) == folder


def test_settled_tables_are_planned_by_their_size(spark):
    from pyspark.sql import functions as F

    big = spark.range(1000).withColumn("k", F.col("id") % 7)
    small = session.settle(big.groupBy("k").agg(F.count("*").alias("n")), "small")
    plan = big.repartition(4).join(small, "k")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    guessed = big.repartition(4).join(big.groupBy("k").agg(F.count("*").alias("n")), "k").join(small, "k")
    assert guessed.count() == 1000
