"""Revenue answers that are kept up to date as lines arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.retail import invoice_month
from tillroll.operators import exact
from tillroll.operators.clean import is_sale, normalize_columns
from tillroll.operators.revenue import in_calendar_order, top_by_revenue
from tillroll.plans.retail import RetailAnswers

KEYS = ["sale", "country", "source_sheet", "month"]
BATCH = "batch"
_STATE = (
    "sale boolean, country string, source_sheet string, month date, limb int, "
    "l0 decimal(38,0), l1 decimal(38,0), l2 decimal(38,0), n long, n_nan long, n_up long, n_down long, lines long"
)


def line_states(raw: DataFrame) -> DataFrame:
    """The lines reduced to exact partial sums by sale, country, sheet and month, and line counts.

    Lines that are no sale are only counted. The size depends on countries and months.
    """
    sale = F.coalesce(is_sale(), F.lit(False))
    lines = raw.transform(normalize_columns).withColumn("sale", sale)
    of_sale = {"country": F.col("country"), "source_sheet": F.col("source_sheet"), "month": F.trunc("invoice_ts", "month")}
    kept = lines.select(
        "sale", *(F.when(F.col("sale"), c).alias(n) for n, c in of_sale.items()), F.when(F.col("sale"), F.col("revenue")).alias("revenue")
    )
    return exact.sum_states(kept, KEYS, "revenue", lines=F.lit(1).cast("long"))


def append_lines(raw: DataFrame, path: str, batch: str) -> None:
    """Add the states of a batch of lines to those at `path`.

    A batch is one partition, replaced as a whole: adding it again, after a failure or with
    corrected lines, counts it once. Earlier lines are not read.
    """
    states = line_states(raw).withColumn(BATCH, F.lit(batch))
    writer = states.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(BATCH).parquet(path)


def read_states(spark: SparkSession, path: str) -> DataFrame:
    """All batches' states."""
    return spark.read.schema(f"{_STATE}, {BATCH} string").parquet(path)


def compact_states(spark: SparkSession, path: str, target: str, batch: str = "all") -> None:
    """The same states as one batch in a new place, for when batches have become many."""
    merged = exact.merge_states(read_states(spark, path), KEYS, ["lines"])
    merged.withColumn(BATCH, F.lit(batch)).write.partitionBy(BATCH).parquet(target)


def answers_of_states(states: DataFrame, k: int = 10) -> RetailAnswers:
    """Both counts and both answers, from states alone: the same, to the bit, however lines were batched."""
    sales = states.filter("sale")
    by_country = exact.totals(sales, ["country"], "total", ["lines"])
    by_month = exact.totals(sales, ["source_sheet", "month"], "total", ["lines"])
    return RetailAnswers(
        counts=states.agg(
            F.coalesce(F.sum("lines"), F.lit(0)).alias("raw_count"),
            F.coalesce(F.sum(F.when(F.col("sale"), F.col("lines"))), F.lit(0)).alias("clean_count"),
        ),
        countries=top_by_revenue(
            by_country.select(
                "country",
                F.col("lines").alias("orders"),
                F.round("total", 2).alias("total_revenue"),
                F.round(F.col("total") / F.col("n"), 2).alias("avg_revenue"),
            ),
            k,
        ),
        months=in_calendar_order(
            by_month.select(
                "source_sheet",
                invoice_month(F.col("month")).alias("invoice_month"),
                F.col("lines").alias("orders"),
                F.round("total", 2).alias("monthly_revenue"),
            )
        ),
    )


def kept_answers(spark: SparkSession, path: str, k: int = 10) -> RetailAnswers:
    """The answers over all batches appended so far."""
    return answers_of_states(read_states(spark, path), k)
