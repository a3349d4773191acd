import os

import pytest

from tillroll.checks.scratch import use_local_scratch
from tillroll.sources import staging


class FakeSession:
    def __init__(self, **settings):
        self.settings = settings
        self.conf = self

    def get(self, key, default=None):
        return self.settings.get(key, default)

    def set(self, key, value):
        self.settings[key] = value


def test_the_shared_folder_of_the_session_is_used(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert staging.staging_path(spark, "x").startswith(folder + "/x-")


def test_every_path_is_new(spark):
    assert staging.staging_path(spark, "x") != staging.staging_path(spark, "x")


def test_a_cluster_without_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.staging_path(FakeSession(**{"spark.master": "spark://host:7077"}), "x")


def test_scratch_is_for_local_sessions_without_a_folder():
    local = FakeSession(**{"spark.master": "local[2]"})
    use_local_scratch(local)
    assert os.path.isdir(local.settings["spark.checkpoint.dir"])
    named = FakeSession(**{"spark.master": "local[2]", "spark.checkpoint.dir": "hdfs:///shared"})
    use_local_scratch(named)
    assert named.settings["spark.checkpoint.dir"] == "hdfs:///shared"
    cluster = FakeSession(**{"spark.master": "spark://host:7077"})
    use_local_scratch(cluster)
    assert "spark.checkpoint.dir" not in cluster.settings


def test_deleted_by_name(spark):
    kept = staging.staged(spark.range(3), "deletable-not")
    gone = staging.staged(spark.range(3), "deletable")
    staging.delete_staged(spark, "deletable")
    assert kept.count() == 3
    with pytest.raises(Exception):
        gone.count()


def test_staged_rows_come_back(spark):
    df = spark.range(10).selectExpr("id", "id % 3 as kind", "cast(null as string) as nothing")
    back = staging.staged(df, "numbers", "kind")
    assert sorted(map(tuple, back.select(*df.columns).collect())) == sorted(map(tuple, df.collect()))
