"""Where intermediate tables go."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def staging_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder the cluster names in `spark.checkpoint.dir`.

    A missing setting is an error, since a machine-local folder would be invisible
    to the other executors.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write once to the shared folder and read back.

    Unlike a cached table, the result does not need its inputs again when an
    executor is lost. The caller owns the folder, see `delete_staged`.
    """
    spark = df.sparkSession
    path = staging_path(spark, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete_staged(spark: SparkSession, name: str) -> None:
    """Delete the tables that were staged under this name, for jobs that are done with them."""
    folder = spark.conf.get("spark.checkpoint.dir").rstrip("/")
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}-" + "?" * 32)
    files = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for found in files.globStatus(pattern) or []:
        files.delete(found.getPath(), True)
