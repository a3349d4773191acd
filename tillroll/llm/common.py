"""What several operators share: reading tables, staged tables, row batches."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.sources import staging

#: White space between words; the same bytes in UTF-8.
WORD = r"[^\x20\x09-\x0D]+"


#: Rows of an Arrow batch: a text has kilobytes, so Spark's default of 10,000 rows takes
#: tens of megabytes on both sides of the pipe, for each task and direction.
ARROW_ROWS = 1_000
_ARROW = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _small_batches(spark: SparkSession) -> None:
    """Lower the session's batch size where it is larger; a smaller one is left alone."""
    if int(spark.conf.get(_ARROW)) > ARROW_ROWS:
        spark.conf.set(_ARROW, str(ARROW_ROWS))


_local_folders: list[tempfile.TemporaryDirectory] = []


def _name_folder(spark: SparkSession) -> None:
    """A `spark.checkpoint.dir` for a session in a single process that names none, as in trials."""
    alone = spark.conf.get("spark.master", "").startswith("local") and "cluster" not in spark.conf.get("spark.master")
    if alone and not spark.conf.get("spark.checkpoint.dir", None):
        if not _local_folders:
            _local_folders.append(tempfile.TemporaryDirectory(prefix="tillroll-"))
        spark.conf.set("spark.checkpoint.dir", _local_folders[0].name)


def staged(df: DataFrame, name: str) -> DataFrame:
    """`df` written once to the folder in `spark.checkpoint.dir` and read back; see `staging.staged`.

    Only a session on a local master may leave the setting out; on a cluster that is an error.
    """
    _name_folder(df.sparkSession)
    _small_batches(df.sparkSession)
    return staging.staged(df, name)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    _small_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def crc_fold(doc_id, folds: int = 4):
    """crc32 of the identifier as text, modulo `folds`; the split into train and held-out rows."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def slices_by_bytes(
    batches: Iterator[pa.RecordBatch], column: str, most: int = 2 << 20
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `most` bytes of `column`, one row at least.

    A task then holds a bounded amount of text and what it derives from it,
    whatever the number of rows that Spark puts into an Arrow batch.
    """
    for batch in batches:
        values = batch.column(batch.schema.get_field_index(column))
        sizes = pa.compute.binary_length(values).fill_null(0).to_numpy(zero_copy_only=False)
        start, total = 0, 0
        for i, size in enumerate(sizes.tolist()):
            if total + size > most and i > start:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if batch.num_rows > start:
            yield batch.slice(start)
        pa.default_memory_pool().release_unused()  # a worker lives on between tasks


def keep_rows(docs: DataFrame, keep: Callable[[list[str | None]], list[bool]], text: str = "text") -> DataFrame:
    """The rows whose text `keep` says yes to, with all their columns and without an exchange."""
    at = docs.columns.index(text)
    _small_batches(docs.sparkSession)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices_by_bytes(batches, text):
            yield batch.filter(pa.array(keep(batch.column(at).to_pylist()), pa.bool_()))

    return docs.mapInArrow(kept, docs.schema)


class RecentResults:
    """Results by key, in two generations: when the young one is full it becomes the old one.

    Holds at most twice `most` results. What is asked for again moves to the young
    generation, so common keys are never computed twice.
    """

    def __init__(self, most: int) -> None:
        self.most = most
        self.young: dict = {}
        self.old: dict = {}

    def __getitem__(self, key):
        found = self.young.get(key)
        if found is None:
            self.young[key] = found = self.old[key]
        return found

    def __setitem__(self, key, value) -> None:
        self.young[key] = value

    def __contains__(self, key) -> bool:
        return key in self.young or key in self.old

    def find(self, keys: list, learn: Callable[[set], None]) -> list:
        """The results of all keys in order; `learn` adds those of the keys that are missing."""
        if len(self.young) > self.most:
            self.old, self.young = self.young, {}
        found = list(map(self.young.get, keys))
        gaps = [i for i, result in enumerate(found) if result is None]
        if gaps:
            missing = {keys[i] for i in gaps}
            if self.old:
                again = missing & self.old.keys() if len(missing) > len(self.old) else {k for k in missing if k in self.old}
                self.young.update((k, self.old[k]) for k in again)
                missing -= again
            if missing:
                learn(missing)
            for i in gaps:
                found[i] = self.young[keys[i]]
        return found
