"""A shared folder for sessions that name none, as in tests and trials on one machine."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

_folders: dict[str, tempfile.TemporaryDirectory] = {}


def use_local_scratch(spark: SparkSession) -> None:
    """Give a session on a local master a `spark.checkpoint.dir` that lives as long as the process.

    A cluster's setting is left alone, and a cluster without one stays without.
    """
    master = spark.conf.get("spark.master", "")
    if spark.conf.get("spark.checkpoint.dir", None) or not master.startswith("local"):
        return
    if master.startswith("local-cluster"):
        return
    if master not in _folders:
        _folders[master] = tempfile.TemporaryDirectory(prefix="tillroll-")
    spark.conf.set("spark.checkpoint.dir", _folders[master].name)
