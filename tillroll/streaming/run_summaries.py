"""The run summary, kept up to date as run documents arrive."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.runs import PREFERRED_RUNS
from tillroll.operators.runs import in_run_order, latest_by_label, run_measures
from tillroll.schemas import RUN_DOCUMENT
from tillroll.sources.documents import DOCUMENT_NAMES, SUMMARY

_PLACES = "file string, document_no long"


def update_summaries(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    name: str = DOCUMENT_NAMES,
    one_per_file: bool = True,
    files_per_batch: int | None = None,
) -> None:
    """Measure the documents that are new below `source` since the last call, and stop.

    `checkpoint` remembers which files were read. Each batch of new files is one partition
    of `target`, written as a whole, so a batch that runs again after a failure replaces
    itself. Of a label that comes again, `read_summaries` takes the last document by file
    and number, which is no matter of when it arrived.
    """
    reader = spark.readStream.schema(RUN_DOCUMENT).options(
        multiLine=one_per_file, recursiveFileLookup=True, pathGlobFilter="*.json", mode="FAILFAST"
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    found = reader.json(source).withColumn("file", F.col("_metadata.file_path")).filter(F.col("file").rlike(name))
    writer = found.writeStream.foreachBatch(partial(_add, target)).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()


def _add(target: str, documents: DataFrame, batch: int) -> None:
    measures = _latest(documents.transform(run_measures))
    by_batch = measures.withColumn("batch", F.lit(batch))
    by_batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(target)


def _latest(measures: DataFrame) -> DataFrame:
    """Of each label the measures of its last document, with its place."""
    placed = measures.withColumns({"at_file": F.col("file"), "at_no": F.col("document_no")})
    return latest_by_label(placed).withColumnsRenamed({"at_file": "file", "at_no": "document_no"})


def read_summaries(spark: SparkSession, target: str, preferred: Sequence[str] = PREFERRED_RUNS) -> DataFrame:
    """What `plans.run_report.run_summary` gives over all documents read so far."""
    measures = spark.read.schema(f"{SUMMARY}, {_PLACES}, batch int").parquet(target).drop("batch")
    return measures.transform(latest_by_label).transform(in_run_order, preferred).drop("run_rank")
