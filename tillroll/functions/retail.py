"""Scalar expressions over retail lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def line_revenue(quantity: Column, price: Column) -> Column:
    """Quantity times price to the cent; null when either is null."""
    return F.round(quantity * price, 2)


def invoice_month(ts: Column) -> Column:
    """`yyyy-MM` in the session time zone; null stays null."""
    return F.date_format(ts, "yyyy-MM")


def whole_number(text: Column) -> Column:
    """Text to int, null if malformed; a decimal point cuts the fraction off.

    The cut form is looked at only where the plain cast fails, so well-formed
    columns never reach the regular expression.
    """
    cut = F.when(text.rlike(r"^\s*[+-]?\d+\.\d*\s*$"), F.substring_index(text, ".", 1))
    return F.coalesce(text.try_cast("int"), cut.try_cast("int"))
