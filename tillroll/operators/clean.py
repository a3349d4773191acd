"""Rename, cast, derive and filter retail lines (use with `df.transform`)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.retail import line_revenue, whole_number
from tillroll.schemas import CLEAN_NAMES


def normalize_columns(df: DataFrame) -> DataFrame:
    """Snake-case names, fixed types, and `revenue`.

    Text that does not parse becomes null and never fails the job, whatever the
    session's ANSI setting. Identifier columns are always strings, also when a
    type-inferring scan made numbers of them. Columns that are not part of the
    line layout pass through.
    """
    named = df.withColumnsRenamed(CLEAN_NAMES)
    quantity = F.col("quantity")
    if isinstance(named.schema["quantity"].dataType, T.StringType):
        quantity = whole_number(quantity)
    typed = {
        "invoice_no": F.col("invoice_no").cast("string"),
        "stock_code": F.col("stock_code").cast("string"),
        "description": F.col("description").cast("string"),
        "quantity": quantity.try_cast("int"),
        "invoice_ts": F.col("invoice_ts").try_cast("timestamp"),
        "price": F.col("price").try_cast("double"),
        "customer_id": F.col("customer_id").cast("string"),
        "country": F.col("country").cast("string"),
        "source_sheet": F.col("source_sheet").cast("string"),
    }
    return named.withColumns(typed).withColumn(
        "revenue", line_revenue(F.col("quantity"), F.col("price"))
    )


def is_sale() -> Column:
    """Predicate of a countable sale: a known country and something paid for; null where unknown."""
    return (F.col("price") > 0) & (F.col("quantity") > 0) & F.col("country").isNotNull()


def keep_sales(df: DataFrame) -> DataFrame:
    """Drop returns, free or adjusted lines, and lines without a country."""
    return df.filter(is_sale())


def clean_lines(df: DataFrame) -> DataFrame:
    """Raw retail lines to the ten-column clean table."""
    return df.transform(normalize_columns).transform(keep_sales)
