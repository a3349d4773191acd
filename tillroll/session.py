"""Session settings the results depend on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app_name: str = "tillroll", **conf: str) -> SparkSession:
    """Get or create a session pinned to UTC.

    Only the time zone is fixed, because `invoice_month` depends on it. Master,
    memory and parallelism belong to spark-submit; partition counts and skewed
    joins are left to adaptive execution, which is on by default.
    """
    builder = SparkSession.builder.appName(app_name).config("spark.sql.session.timeZone", "UTC")
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
