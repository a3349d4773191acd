"""Counts, grouped revenue, ordering and top-k over clean lines.

Every aggregate here combines on the map side first, so a country or sheet that
holds most of the rows reaches the exchange as one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.retail import invoice_month
from tillroll.operators.clean import is_sale


def row_count(df: DataFrame) -> DataFrame:
    """One row, one column: `row_count`."""
    return df.agg(F.count("*").alias("row_count"))


def _revenue_sum(exact: bool) -> Column:
    """Sum of the line revenues, as a double.

    The plain double sum is the default. `exact=True` adds up decimals instead:
    the total then does not depend on task order, at the price of a wider
    aggregation buffer, and a line beyond 16 integer digits fails the job, with
    ANSI mode on or off.
    """
    return F.sum(_exact_revenue()).cast("double") if exact else F.sum("revenue")


def _exact_revenue() -> Column:
    revenue = F.col("revenue")
    exact = revenue.try_cast("decimal(18,2)")
    problem = F.raise_error(F.concat(F.lit("No exact decimal for the revenue "), revenue.cast("string")))
    return F.when(revenue.isNotNull() & exact.isNull(), problem.cast("decimal(18,2)")).otherwise(exact)


def revenue_by_country(lines: DataFrame, exact: bool = False) -> DataFrame:
    """`country, orders, total_revenue, avg_revenue`; `orders` counts lines, not invoices."""
    total = _revenue_sum(exact)
    mean = total / F.count("revenue") if exact else F.avg("revenue")
    return lines.groupBy("country").agg(
        F.count("*").alias("orders"),
        F.round(total, 2).alias("total_revenue"),
        F.round(mean, 2).alias("avg_revenue"),
    )


def revenue_by_sheet_month(lines: DataFrame, exact: bool = False) -> DataFrame:
    """`source_sheet, invoice_month, orders, monthly_revenue`.

    Rows are grouped on the month's first day, a plain integer inside Spark, and
    the `yyyy-MM` text is made once per group: same groups, no text per line.
    """
    month = F.trunc(F.col("invoice_ts"), "month")
    return (
        lines.groupBy("source_sheet", month.alias("month"))
        .agg(
            F.count("*").alias("orders"),
            F.round(_revenue_sum(exact), 2).alias("monthly_revenue"),
        )
        .select(
            "source_sheet",
            invoice_month(F.col("month")).alias("invoice_month"),
            "orders",
            "monthly_revenue",
        )
    )


def revenue_groups(normalized: DataFrame, exact: bool = False) -> DataFrame:
    """The smallest table that answers both questions and both counts from one scan.

    One row per country, sheet and month of the sales, `sale` being true, and
    one row for all other lines together: `sale, country, source_sheet, month,
    lines, revenue`. Its size depends on countries and months, not on lines. With
    `exact` the revenue is a decimal, so that the sums of these sums are exact too.
    """
    sale = F.coalesce(is_sale(), F.lit(False))
    counted = F.when(F.col("sale"), _exact_revenue()) if exact else F.col("revenue")
    revenue = F.sum(counted)
    flagged = normalized.select(
        sale.alias("sale"), "country", "source_sheet", "invoice_ts", "revenue"
    )
    keys = {
        "country": F.col("country"),
        "source_sheet": F.col("source_sheet"),
        "month": F.trunc(F.col("invoice_ts"), "month"),
    }
    return flagged.groupBy(
        "sale", *[F.when(F.col("sale"), key).alias(name) for name, key in keys.items()]
    ).agg(F.count("*").alias("lines"), revenue.alias("revenue"))


def counts_of_groups(groups: DataFrame) -> DataFrame:
    """`raw_count, clean_count` of the lines behind the groups; one row."""
    return groups.agg(
        F.coalesce(F.sum("lines"), F.lit(0)).alias("raw_count"),
        F.coalesce(F.sum(F.when(F.col("sale"), F.col("lines"))), F.lit(0)).alias("clean_count"),
    )


def countries_of_groups(groups: DataFrame) -> DataFrame:
    """`revenue_by_country` of the lines behind the groups."""
    total, lines = F.sum("revenue").cast("double"), F.sum("lines")
    return (
        groups.filter("sale")
        .groupBy("country")
        .agg(
            lines.alias("orders"),
            F.round(total, 2).alias("total_revenue"),
            F.round(total / lines, 2).alias("avg_revenue"),
        )
    )


def months_of_groups(groups: DataFrame) -> DataFrame:
    """`revenue_by_sheet_month` of the lines behind the groups."""
    months = groups.filter("sale").groupBy("source_sheet", "month")
    return months.agg(
        F.sum("lines").alias("orders"),
        F.round(F.sum("revenue").cast("double"), 2).alias("monthly_revenue"),
    ).select(
        "source_sheet",
        invoice_month(F.col("month")).alias("invoice_month"),
        "orders",
        "monthly_revenue",
    )


def top_by_revenue(groups: DataFrame, k: int = 10) -> DataFrame:
    """The k best countries; the name breaks ties so the answer is repeatable."""
    return groups.orderBy(F.desc("total_revenue"), F.asc("country")).limit(k)


def in_calendar_order(groups: DataFrame, k: int | None = None) -> DataFrame:
    """By sheet and month, nulls first; the first k groups if k is given."""
    ordered = groups.orderBy("source_sheet", "invoice_month")
    return ordered if k is None else ordered.limit(k)
