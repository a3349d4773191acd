"""Partition layout and cache of a table that several queries read."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What the revenue questions read; the other six columns need no cache.
QUERY_COLUMNS = ["country", "source_sheet", "invoice_ts", "revenue"]


def cluster_by(df: DataFrame, key: str) -> DataFrame:
    """Rows of one key close together, no partition oversized: for tables to be written.

    A rebalance lets adaptive execution cut a hot key, also one of equal rows,
    into several partitions and join small ones. Write the result: Spark does
    not adapt a plan that it caches, so under `persisted` the key would be one
    partition again.
    """
    return df.hint("rebalance", key)


def spread_evenly(df: DataFrame, partitions: int) -> DataFrame:
    """Equal partitions whatever the keys: the layout for a cache of skewed rows.

    A grouping then exchanges one row of partial results per task and key.
    """
    return df.repartition(partitions)


def partition_by_key(df: DataFrame, key: str, partitions: int) -> DataFrame:
    """Hash layout with a fixed partition count: each key in exactly one partition.

    A grouping on the key then needs no exchange. Only for keys known to be
    even, since the largest key decides the largest partition.
    """
    return df.repartition(partitions, key)


SLOT = "slot"  # which part of a hot key a row belongs to


def write_buckets(
    df: DataFrame, table: str, path: str, key: str, buckets: int, hot_share: float = 0.1, slots: int = 8
) -> None:
    """`df` as a table at `path`, bucketed and sorted by `key`, that later sessions can open.

    A key with more than `hot_share` of the rows is dealt over `slots` parts, which the
    column `slot` numbers, so that no bucket holds all of it; other keys have slot 0. Group
    by key and slot, then by key: the first step needs no exchange, and what the second
    exchanges is a row per key and slot. At most 1 / `hot_share` keys reach the driver.
    """
    counts = df.groupBy(key).count()
    total = counts.agg(F.sum("count")).first()[0] or 0
    hot = [r[0] for r in counts.filter(F.col("count") > F.lit(total * hot_share)).select(key).collect()]
    part = F.pmod(F.monotonically_increasing_id(), F.lit(slots)).cast("int")
    dealt = df.withColumn(SLOT, F.when(_is_one_of(F.col(key), hot), part).otherwise(0))
    # one file per bucket: rows are dealt by the buckets' own hash
    placed = dealt.repartition(buckets, key, SLOT).sortWithinPartitions(key, SLOT)
    writer = placed.write.format("parquet").bucketBy(buckets, key, SLOT).sortBy(key, SLOT)
    writer.option("path", path).saveAsTable(table)


def _is_one_of(column: Column, values: Sequence) -> Column:
    found = F.lit(False)
    for value in values:
        found = found | column.eqNullSafe(F.lit(value))
    return found


def open_buckets(spark: SparkSession, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """A table that another session wrote with `write_buckets` at `path`, with its layout."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
    place = path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
        f"CLUSTERED BY (`{key}`, {SLOT}) SORTED BY (`{key}`, {SLOT}) INTO {buckets} BUCKETS LOCATION '{place}'"
    )
    return spark.table(table)


@contextmanager
def persisted(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    level: StorageLevel = StorageLevel.MEMORY_AND_DISK,
) -> Iterator[DataFrame]:
    """Cache inside a `with` block; the cache is gone after it.

    Name the columns the block will read: a cache is never pruned afterwards.
    """
    cached = (df.select(*columns) if columns else df).persist(level)
    try:
        yield cached
    finally:
        cached.unpersist()


def materialize(cached: DataFrame) -> int:
    """Fill the cache with one full pass; returns the number of rows."""
    return cached.count()
