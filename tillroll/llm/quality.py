"""Quality rules: exact counts for the base rule, boosted trees for the verdict."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm import boosting
from tillroll.llm.common import WORD, crc_fold, keep_rows, slices_by_bytes

SAMPLE_ROWS = 16_384  # labelled rows that the trees are fitted on, in expectation at most
WRONGLY_REJECTED = 0.002  # share of good training rows that the verdict may reject
REPEATED_PERCENT = 50
LEAST_WORDS = 50

#: Statistics that the trees see, and how the quality score may move with each.
FEATURES = {
    "log_words": 0,
    "word_length": 0,
    "symbols_per_word": -1,
    "duplicate_line_share": -1,
    "repeated_word_share": -1,
    "distinct_word_share": 0,
    "digit_share": 0,
    "upper_share": 0,
    "odd_character_share": 0,
    "top_word_share": -1,
    "words_per_line": 0,
    "same_as_previous_share": -1,
    "longest_word": 0,
    "sentence_end_share": 0,
}
SIGNS = np.array(list(FEATURES.values()))

_word = re.compile(WORD)
_symbols = "#*$%&|<>"
_digit = re.compile(r"[0-9]")
_upper = re.compile(r"[A-Z]")
_odd = re.compile(r"[^\w\s]")
_end = re.compile(r"[.!?](?=\s|$)")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def count(text: str) -> tuple[list[int], list[float]]:
    """The counts of COUNTS and the statistics of FEATURES of one whole text."""
    words = _word.findall(text)
    n = len(words)
    word_chars = sum(map(len, words))
    n_symbols = sum(map(text.count, _symbols))
    lines = [line for line in text.split("\n") if _word.search(line)]
    n_dup_lines = len(lines) - len(set(lines))
    n_repeat, same = 0, 0
    if n >= 2:
        ids = np.fromiter(map(hash, words), dtype=np.int64, count=n).astype(np.uint64)
        same = int((ids[1:] == ids[:-1]).sum())
    if n >= 4:
        mixed = ids * np.uint64(0x9E3779B97F4A7C15)
        windows = (mixed[:-2] ^ (mixed[1:-1] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        windows = (windows ^ (windows >> np.uint64(32)) ^ mixed[2:]) * np.uint64(0x94D049BB133111EB)
        _, inverse, times = np.unique(windows, return_inverse=True, return_counts=True)
        repeated = times[inverse] > 1
        covered = np.zeros(n, dtype=bool)
        for j in range(3):
            covered[j : j + n - 2] |= repeated
        n_repeat = int(covered.sum())
    per_word, per_char = 1 / max(n, 1), 1 / max(word_chars, 1)
    often = Counter(words)
    features = [
        np.log1p(n),
        word_chars * per_word,
        n_symbols * per_word,
        n_dup_lines / max(len(lines), 1),
        n_repeat * per_word,
        len(often) * per_word,
        len(_digit.findall(text)) * per_char,
        len(_upper.findall(text)) * per_char,
        len(_odd.findall(text)) * per_char,
        max(often.values(), default=0) * per_word,
        n / max(len(lines), 1),
        same * per_word,
        max(map(len, often), default=0),
        len(_end.findall(text)) * per_word,
    ]
    return [n, word_chars, n_symbols, n_dup_lines, n_repeat], features


def _stats_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    found = [count(t or "") for t in texts]
    return np.array([c for c, _ in found], dtype=np.int64).reshape(-1, len(COUNTS)), np.array(
        [f for _, f in found], dtype=float
    ).reshape(-1, len(FEATURES))


def _frame(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))


def _base_failed(counts: np.ndarray) -> np.ndarray:
    n, repeated = counts[:, 0], counts[:, 4]
    return (n < LEAST_WORDS) | (100 * repeated > REPEATED_PERCENT * n)


def sample_features(sample: DataFrame) -> DataFrame:
    """`doc_id, y, features, text_hash` of `doc_id, y, text`; a null text counts as empty."""

    def stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices_by_bytes(batches, "text"):
            _, features = _stats_of(batch.column(2).to_pylist())
            listed = pa.array(features.tolist(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), listed, batch.column(3)], names=["doc_id", "y", "features", "text_hash"]
            )

    schema = f"doc_id {sample.schema['doc_id'].dataType.simpleString()}, y double, features array<double>, text_hash long"
    return sample.select("doc_id", "y", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(stats, schema)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, text: str = "text") -> DataFrame:
    """`doc_id, text, y`: about `rows` labelled documents outside the held-out fold, chosen by hash.

    A document with several labels gets the smallest; null labels are none. The
    choice depends on the identifiers alone, so a task that runs again chooses alike.
    """
    given = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (crc_fold(F.col("doc_id")) != 2))
    given = given.groupBy("doc_id").agg(F.min(label).cast("double").alias("y"))
    share = min(1.0, rows / max(given.count(), 1))
    place = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = given.filter(place < share)
    return docs.select("doc_id", F.col(text).alias("text")).join(chosen, "doc_id")


def fit_quality(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> tuple[boosting.Forest, float]:
    """Trees and the least score that is kept, from a bounded sample of labelled rows.

    The threshold is taken from rows that the scoring trees have not seen (two
    halves score each other): it rejects at most WRONGLY_REJECTED of the good ones
    and never asks for more than 0.5. Without labels everything is kept.
    """
    sample = labelled_sample(docs, labels, "quality", rows)
    got = sample_features(sample).orderBy("doc_id", "text_hash").toPandas()  # bounded by `rows`
    x = np.array(got["features"].tolist(), dtype=float).reshape(-1, len(FEATURES))
    y = got["y"].to_numpy(dtype=float)
    if len(set(y.tolist())) < 2:
        return boosting.fit(x[:0], y[:0], SIGNS), 0.0
    half = np.arange(len(y)) % 2 == 0
    unseen = np.empty(len(y))
    unseen[half] = boosting.fit(x[~half], y[~half], SIGNS).probability(x[half])
    unseen[~half] = boosting.fit(x[half], y[half], SIGNS).probability(x[~half])
    least = np.quantile(unseen[y > 0], WRONGLY_REJECTED, method="lower")
    return boosting.fit(x, y, SIGNS), float(min(0.5, least))


def judge_quality(
    docs: DataFrame, model: tuple[boosting.Forest, float], doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """`doc_id`, the counts, `score`, `base_failed` and `kept` of each row, one for one.

    Null and empty texts have no words and fail the base rule. Repeated rows stay
    repeated, null identifiers stay null, and other columns are not read.
    """
    frame = _frame(docs, doc_id, text)
    forest, least = model
    schema = f"doc_id {frame.schema['doc_id'].dataType.simpleString()}, " + ", ".join(f"{c} long" for c in COUNTS)
    schema += ", score double, base_failed boolean, kept boolean"

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices_by_bytes(batches, "text"):
            counts, features = _stats_of(batch.column(1).to_pylist())
            score = forest.probability(features)
            failed = _base_failed(counts)
            columns = [*counts.T, score, failed, ~failed & (score >= least)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, columns)],
                names=["doc_id", *COUNTS, "score", "base_failed", "kept"],
            )

    return frame.mapInArrow(judge, schema)


def keep_good(docs: DataFrame, model: tuple[boosting.Forest, float], text: str = "text") -> DataFrame:
    """The rows that `judge_quality` keeps, with all their columns."""
    forest, least = model

    def good(texts: list[str | None]) -> list[bool]:
        counts, features = _stats_of(texts)
        return (~_base_failed(counts) & (forest.probability(features) >= least)).tolist()

    return keep_rows(docs, good, text)
