"""Scalar expressions over spreadsheet cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: built-in date formats, date tokens, day zero ---------------
DATE_FORMAT_IDS = [14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47]
DATE_TOKENS = ["yy", "dd", "mm", "hh", "ss"]
DAY_ZERO = "1899-12-30 00:00:00"
FIRST_SERIAL = -693_593.0  # 0001-01-01
END_SERIAL = 2_958_466.0  # 10000-01-01
# -----------------------------------------------------------------------------

MICROS_PER_DAY = 86_400_000_000


def column_index(ref: Column) -> Column:
    """Zero-based column of a cell reference: `A1` is 0, `AA10` is 26.

    A reference without leading capitals fails the job; null stays null. Up to
    three letters, all the file format has columns for, are spelled out; only
    longer ones take the slower regular expression and fold.
    """

    def code(position: int) -> Column:
        return F.ascii(F.substring(ref, position, 1))

    def is_letter(position: int) -> Column:
        return code(position).between(65, 90)

    def digit(position: int) -> Column:
        return code(position) - 64

    longer = F.aggregate(
        F.split(F.regexp_extract(ref, "^([A-Z]+)", 1), ""),
        F.lit(0),
        lambda total, letter: total * 26 + F.ascii(letter) - 64,
    )
    problem = F.raise_error(F.concat(F.lit("Unexpected cell reference: "), ref))
    return F.when(
        ref.isNotNull(),
        F.when(~is_letter(1), problem.cast("int"))
        .when(~is_letter(2), digit(1) - 1)
        .when(~is_letter(3), digit(1) * 26 + digit(2) - 1)
        .when(~is_letter(4), digit(1) * 676 + digit(2) * 26 + digit(3) - 1)
        .otherwise(longer - 1),
    )


def is_date_code(code: Column) -> Column:
    """Does a number format code mention a date or time token anywhere?"""
    return F.coalesce(F.lower(code).rlike("|".join(DATE_TOKENS)), F.lit(False))


def serial_to_timestamp(serial: Column) -> Column:
    """Days since day zero to a zoneless timestamp, rounded to the microsecond.

    Null outside the years 1 to 9999. Whole days and the rest are taken apart
    first: the rest alone fits a double to far below a microsecond.
    """
    days = F.floor(serial)
    rest = F.rint((serial - days) * F.lit(float(MICROS_PER_DAY))).cast("bigint")
    micros = days.cast("bigint") * F.lit(MICROS_PER_DAY) + rest
    moment = F.timestamp_add("MICROSECOND", micros, F.lit(DAY_ZERO).cast("timestamp_ntz"))
    return F.when((serial >= FIRST_SERIAL) & (serial < END_SERIAL), moment)


def timestamp_text(ts: Column) -> Column:
    """`yyyy-MM-dd HH:mm:ss` with the seconds cut off, and no time at midnight."""
    text = F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
    return F.when(text.endswith(" 00:00:00"), F.substring(text, 1, 10)).otherwise(text)


def serial_to_text(serial: Column) -> Column:
    return timestamp_text(serial_to_timestamp(serial))


def fit_width(row: Column, width: int) -> Column:
    """An array of exactly `width` texts: cut, or padded with empty texts."""
    return F.slice(F.concat(row, F.array_repeat(F.lit(""), width)), 1, width)
