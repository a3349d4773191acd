"""Run-metrics documents: written from query results, rolled up to a comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.runs import PREFERRED_RUNS
from tillroll.operators.runs import in_run_order, latest_by_label, run_measures
from tillroll.schemas import COUNTRY_RESULT, MONTH_RESULT


def run_summary(documents: DataFrame, preferred: Sequence[str] = PREFERRED_RUNS) -> DataFrame:
    """One ordered row per run label with its four measures.

    The only shuffle before the sort carries one row of numbers per document,
    combined per label on the map side.
    """
    ordered = documents.transform(run_measures).transform(latest_by_label)
    return ordered.transform(in_run_order, preferred).drop("run_rank")


def run_document(
    run_label: str, row_count: DataFrame, top: DataFrame, monthly: DataFrame, **fields: Column
) -> DataFrame:
    """One document with the row count and both result samples, as a one-row table.

    `top` and `monthly` must be the limited results, since a document holds them
    whole. `fields` adds further columns of the document, such as `app_name`.
    """

    def pick(df: DataFrame, counted=None, country=None, month=None) -> DataFrame:
        return df.select(
            (F.lit(None).cast("long") if counted is None else counted).alias("counted"),
            (F.lit(None).cast(COUNTRY_RESULT) if country is None else country).alias("country"),
            (F.lit(None).cast(MONTH_RESULT) if month is None else month).alias("month"),
        )

    pieces = (
        pick(row_count, counted=F.col("row_count"))
        .unionByName(pick(top, country=F.struct(*COUNTRY_RESULT.names)))
        .unionByName(pick(monthly, month=F.struct(*MONTH_RESULT.names)))
    )
    by_revenue = F.transform(
        F.array_sort(
            F.transform(
                F.collect_list("country"),
                lambda c: F.struct((-c["total_revenue"]).alias("rank"), c["country"], c.alias("c")),
            )
        ),
        lambda ranked: ranked["c"],
    )
    return pieces.agg(
        F.max("counted").alias("row_count"),
        F.struct(
            by_revenue.alias("top_countries_by_revenue"),
            F.sort_array(F.collect_list("month")).alias("monthly_revenue_sample"),
        ).alias("samples"),
    ).select(
        F.lit(run_label).alias("run_label"),
        *[value.alias(name) for name, value in fields.items()],
        "row_count",
        "samples",
    )
