"""Run-metrics documents to flat tables and comparable measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.runs import (
    PREFERRED_RUNS,
    preparation_time,
    run_rank,
    storage_memory,
    total_time,
    work_time,
)


def flatten_actions(documents: DataFrame) -> DataFrame:
    """One row per action with its position; a run without actions keeps one row."""
    return documents.select(
        "file", "run_label", F.posexplode_outer("actions").alias("pos", "action")
    ).select(
        "file",
        "run_label",
        "pos",
        F.col("action.label").alias("label"),
        F.col("action.duration_sec").alias("duration_sec"),
        F.col("action.job_stage_info").alias("job_stage_info"),
        F.col("action.memory_snapshot").alias("memory_snapshot"),
    )


def flatten_stages(documents: DataFrame) -> DataFrame:
    """One row per stage of every job of every action; empty levels keep one row."""
    jobs = flatten_actions(documents).select(
        "file",
        "run_label",
        "pos",
        "label",
        F.explode_outer("job_stage_info.jobs").alias("job"),
    )
    stages = jobs.select(
        "file",
        "run_label",
        "pos",
        "label",
        F.col("job.job_id").alias("job_id"),
        F.explode_outer("job.stages").alias("stage"),
    )
    return stages.select(
        "file",
        "run_label",
        "pos",
        "label",
        "job_id",
        F.col("stage.stage_id").alias("stage_id"),
        F.col("stage.name").alias("stage_name"),
        F.col("stage.num_tasks").alias("num_tasks"),
    )


def run_measures(documents: DataFrame) -> DataFrame:
    """The four measures of each document, row by row, with its place among all documents."""
    actions = F.col("actions")
    return documents.select(
        "file",
        F.coalesce("document_no", F.lit(0)).alias("document_no"),
        "run_label",
        total_time(F.col("total_runtime_sec")).alias("time_total_sec"),
        preparation_time(actions).alias("time_preprocess_sec"),
        work_time(actions).alias("time_work_sec"),
        storage_memory(actions).alias("ram_consumption_mb"),
    )


def latest_by_label(measures: DataFrame) -> DataFrame:
    """One row per run label: of documents that share it, the last by file and document number.

    The measures take no part in the order, unless two documents have one place.
    """
    place = ["file", "document_no"]
    values = [c for c in measures.columns if c not in (*place, "run_label")]
    last = F.max(F.struct(*place, *values)).alias("last")
    return (
        measures.groupBy("run_label")
        .agg(last)
        .select("run_label", *[F.col(f"last.{name}") for name in values])
    )


def in_run_order(runs: DataFrame, preferred: Sequence[str] = PREFERRED_RUNS) -> DataFrame:
    """Adds `run_rank` and sorts: the preferred labels in their order, then all others."""
    return runs.withColumn("run_rank", run_rank(F.col("run_label"), preferred)).orderBy(
        "run_rank", "run_label"
    )
