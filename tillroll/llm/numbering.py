"""Row numbers within groups of any size, from DataFrame operations alone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import staged

_PARTITION, _AT, _OFFSET = "numbered_partition", "numbered_at", "numbered_offset"
_ROWS = (1 << 33) - 1  # the part of monotonically_increasing_id() that counts within a partition


def numbered(df: DataFrame, group: str, order: Sequence[Column], place: str, name: str) -> DataFrame:
    """`df` with `place`, counted from 0 within each value of `group` in the given order.

    A window would bring a whole group to one task. Here the rows are range
    partitioned and sorted by group and order, so that a large group spreads over
    many partitions, and a partition's first number comes from the counts of those
    before it: one row per group and partition. Rows that tie in the order get
    different numbers. A null group is a group. The sorted rows are a written table,
    so a task that runs again meets the same partitions.
    """
    keys = [F.col(group).asc_nulls_first(), *order]
    spread = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows = staged(
        spread.withColumns(
            {_PARTITION: F.spark_partition_id(), _AT: F.monotonically_increasing_id().bitwiseAND(F.lit(_ROWS))}
        ),
        name,
    )
    counted = rows.groupBy(group, _PARTITION).agg(F.min(_AT).alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy(group).orderBy(_PARTITION).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.select(
        F.col(group).alias("numbered_group"),
        F.col(_PARTITION).alias("numbered_in"),
        (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias(_OFFSET),
    )
    same = rows[group].eqNullSafe(offsets["numbered_group"]) & (rows[_PARTITION] == offsets["numbered_in"])
    return rows.join(offsets, same).select(*df.columns, (F.col(_AT) + F.col(_OFFSET)).alias(place))
