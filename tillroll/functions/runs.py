"""Expressions over the `actions` array of one run-metrics document.

A document is one row, so its measures are plain column expressions: no
explode, no shuffle, and sums in the document's own order. Every measure rounds an
exact tie to the even digit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: action labels and the order of known runs ------------------
COUNT_LABEL = "count input rows"
CACHE_LABEL = "materialize cached dataframe"
TOP_LABEL = "top countries by revenue"
MONTHS_LABEL = "monthly revenue by source sheet"
PREFERRED_RUNS = [
    "1DataNode",
    "1DataNode_opt",
    "3DataNode",
    "3DataNode_opt",
    "3DataNode_2Workers",
    "3DataNode_2Workers_opt",
]
UNKNOWN_RANK = 999
# -----------------------------------------------------------------------------

#: Our own step: the scan that reduces all lines to groups. It is work, not preparation.
GROUPS_LABEL = "reduce lines to groups"


def _total(values: Column) -> Column:
    return F.aggregate(
        F.coalesce(values, F.array().cast("array<double>")),
        F.lit(0.0),
        lambda total, value: total + F.coalesce(value, F.lit(0.0)),
    )


def first_duration(actions: Column, label: str) -> Column:
    """Seconds of the first action with this label; 0 if there is none."""
    position = F.nullif(F.array_position(actions["label"], label), F.lit(0))
    found = F.try_element_at(actions["duration_sec"], position.cast("int"))
    return F.bround(F.coalesce(found, F.lit(0.0)), 3)


def preparation_time(actions: Column) -> Column:
    """The cache fill if it took any time, else the row count."""
    cache = first_duration(actions, CACHE_LABEL)
    return F.when(cache > 0, cache).otherwise(first_duration(actions, COUNT_LABEL))


def work_time(actions: Column) -> Column:
    """Seconds of all actions that are not preparation."""
    prepares = F.array(F.lit(COUNT_LABEL), F.lit(CACHE_LABEL))
    worked = F.filter(
        F.arrays_zip(actions["label"].alias("label"), actions["duration_sec"].alias("sec")),
        lambda action: ~F.coalesce(F.array_contains(prepares, action["label"]), F.lit(False)),
    )
    return F.bround(_total(worked["sec"]), 3)


def storage_memory(actions: Column) -> Column:
    """Storage megabytes of all executors at the last action; 0 if unknown."""
    executors = actions["memory_snapshot"]["executors"]
    last = F.try_element_at(executors, F.lit(-1))
    return F.bround(_total(last["used_mb"]), 2)


def total_time(seconds: Column) -> Column:
    return F.bround(F.coalesce(seconds, F.lit(0.0)), 3)


def run_rank(run_label: Column, preferred: Sequence[str] = PREFERRED_RUNS) -> Column:
    """Position in the preferred list; unknown labels come after all known ones."""
    position = F.array_position(F.array(*[F.lit(name) for name in preferred]), run_label)
    return F.coalesce(F.nullif(position, F.lit(0)) - 1, F.lit(UNKNOWN_RANK)).cast("int")


def megabytes(size: Column) -> Column:
    """Bytes to megabytes at two decimals; an exact tie goes to the even digit."""
    return F.bround(size / 1024 / 1024, 2)


def executor_memory(status: Column) -> Column:
    """Storage status `(executor, max_bytes, remaining_bytes)` to megabytes, by executor."""
    return F.array_sort(
        F.transform(
            status,
            lambda one: F.struct(
                one["executor"].alias("executor"),
                megabytes(one["max_bytes"]).alias("max_mb"),
                megabytes(one["max_bytes"] - one["remaining_bytes"]).alias("used_mb"),
                megabytes(one["remaining_bytes"]).alias("remaining_mb"),
            ),
        )
    )
