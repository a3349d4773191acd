"""The revenue questions, asked of clean lines."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators.clean import normalize_columns
from tillroll.operators.layout import SLOT
from tillroll.operators.revenue import (
    counts_of_groups,
    countries_of_groups,
    in_calendar_order,
    months_of_groups,
    revenue_by_country,
    revenue_by_sheet_month,
    revenue_groups,
    top_by_revenue,
)
from tillroll.sources.staging import staged


def country_revenue(lines: DataFrame, k: int = 10, exact: bool = False) -> DataFrame:
    """Top countries by revenue."""
    return top_by_revenue(revenue_by_country(lines, exact), k)


def monthly_revenue(lines: DataFrame, k: int | None = 12, exact: bool = False) -> DataFrame:
    """Revenue by sheet and month: the earliest k groups, or all with `k=None`."""
    return in_calendar_order(revenue_by_sheet_month(lines, exact), k)


def country_revenue_of_buckets(table: DataFrame, k: int = 10) -> DataFrame:
    """Top countries by revenue over a table of `layout.write_buckets` by country.

    Lines are added up where they lie; only a row per country and slot is exchanged.
    """
    parts = table.groupBy("country", SLOT).agg(
        F.count("*").alias("orders"), F.sum("revenue").alias("revenue"), F.count("revenue").alias("n")
    )
    groups = parts.groupBy("country").agg(
        F.sum("orders").alias("orders"),
        F.round(F.sum("revenue"), 2).alias("total_revenue"),
        F.round(F.sum("revenue") / F.sum("n"), 2).alias("avg_revenue"),
    )
    return top_by_revenue(groups, k)


class RetailAnswers(NamedTuple):
    counts: DataFrame  # raw_count, clean_count
    countries: DataFrame  # top countries by revenue
    months: DataFrame  # every sheet and month


def group_lines(raw: DataFrame, exact: bool = False, name: str = "revenue-groups") -> DataFrame:
    """The lines reduced once to `revenue_groups`, a small table in the shared folder."""
    return staged(raw.transform(normalize_columns).transform(revenue_groups, exact), name)


def answer_all(raw: DataFrame, k: int = 10, exact: bool = False) -> RetailAnswers:
    """Both counts and both answers from one scan of the raw lines.

    Asked one by one, each of them scans the lines again. Here they read what
    `group_lines` left of the lines. `exact` adds up decimals, see `revenue_by_country`.
    """
    groups = group_lines(raw, exact)
    return RetailAnswers(
        counts=counts_of_groups(groups),
        countries=top_by_revenue(countries_of_groups(groups), k),
        months=in_calendar_order(months_of_groups(groups)),
    )
