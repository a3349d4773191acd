"""A text corpus in five stages, each over all that the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next one's docs. All but the last return the columns
of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import near_duplicates, packing, pii, quality, toxicity
from tillroll.llm.common import read_table, staged
from tillroll.llm.queries import surrogate_key, tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays under the threshold.

    Null and empty texts score like any text without a known term, and stay where that is
    a low score. Repeated rows share their fate; rows without identifier are judged by
    their text; without labels every document stays. An empty table stays empty.
    """
    index = toxicity.fit_toxicity(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, index)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the trees.

    Null, empty and short texts fail the base rule and go. Repeated rows share their fate,
    and identifiers play no part; without labels only the base rule decides.
    """
    model = quality.fit_quality(docs, read_table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates one row.

    Rows are told apart by identifier and text, so two texts of one identifier are two
    rows, and of rows alike in both one stays. The row with the smallest identifier is
    chosen, and one without identifier only where no other is in the component. Null and
    empty texts are like nothing but themselves: one row of each identifier stays.
    """
    no_id, text_hash = F.col("doc_id").isNull().alias("no_id"), F.xxhash64("text").alias("text_hash")
    keyed = docs.withColumn("near_key", F.struct(no_id, "doc_id", text_hash))
    found = near_duplicates.near_duplicates(keyed, "near_key")
    leaders = found.filter(F.col("component_id") == F.col("doc_id")).select(F.col("doc_id").alias("near_key"))
    chosen = keyed.join(leaders.distinct(), "near_key", "left_semi").dropDuplicates(["near_key"])
    return chosen.select(*docs.columns)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by surrogates.

    Every row stays, repeated ones too; null and empty texts stay what they are.
    """
    return pii.replace_in_rows(docs, surrogate_key(spark))


#: Words that a packing worker of the pipeline remembers within a task; there it follows four other stages.
CACHED_WORDS = 60_000


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces and their places in training sequences.

    Null and empty texts are one piece with the end mark alone; repeated rows and rows
    without identifier are documents of their own.
    """
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"), cached_words=CACHED_WORDS, keep_words=False)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", drop_low_quality),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("PII", replace_personal_data),
    ("best-fit packing", pack_sequences),
]

#: No stage but the third can be said in SQL, and that one not over whole tables.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the table `documents`."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
