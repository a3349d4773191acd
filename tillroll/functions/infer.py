"""Types of text columns, by the same steps as Spark's own inference over delimited text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What one text can be; a column's kinds are the union of its texts' bits.
INTEGER, LONG, DECIMAL, DOUBLE, DATE, TIMESTAMP, BOOLEAN, TEXT = (1 << i for i in range(8))
_WHOLE = r"^[+-]?[0-9]+$"
_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[dDfF]?\s*$"
_NAMED = ["NaN", "Inf", "-Inf", "Infinity", "-Infinity", "+Infinity"]
_DIGITS = 38  # of the widest decimal


def kind_of(text: Column) -> Column:
    """The bit of the narrowest type that the text fits; 0 for null.

    The first character decides which types are tried at all: most texts begin with a letter.
    """
    first = F.ascii(text)  # of an empty text 0
    whole = F.when(text.try_cast("int").isNotNull(), INTEGER).when(text.try_cast("bigint").isNotNull(), LONG)
    whole = whole.when(text.try_cast(f"decimal({_DIGITS},0)").isNotNull(), DECIMAL).otherwise(DOUBLE)
    moment = F.when((F.length(text) == 10) & text.rlike(r"^\d{4}-\d{2}-\d{2}$") & text.try_cast("date").isNotNull(), DATE)
    moment = moment.when(text.try_cast("timestamp").isNotNull(), TIMESTAMP).otherwise(TEXT)
    numeric = F.when(text.rlike(_WHOLE), whole).when(text.rlike(_NUMBER) | text.isin(_NAMED), DOUBLE).otherwise(moment)
    worded = F.when(text.isin(_NAMED), DOUBLE).when(F.lower(text).isin("true", "false"), BOOLEAN)
    # letters; what is no ASCII letter, digit or sign may still be white space before a number
    letter = ((first >= 65) & (first <= 90)) | ((first >= 97) & (first <= 122))
    timely = worded.when(text.startswith("T") & text.try_cast("timestamp").isNotNull(), TIMESTAMP).otherwise(TEXT)
    return F.when(text.isNull(), 0).when(letter, timely).otherwise(numeric)


def kinds_of(text: Column) -> Column:
    """An aggregate: the kinds of all texts. It merges in any order, so partial results combine."""
    return F.bit_or(kind_of(text))


def digits_of(text: Column) -> Column:
    """An aggregate: digits of the longest whole number."""
    return F.max(F.when(text.rlike(_WHOLE), F.length(F.regexp_replace(text, r"^[+-]?0*", ""))))


def is_settled(kinds: int | None) -> bool:
    """Is a column with these kinds text, whatever else is still to come?"""
    return bool(kinds) and type_of(kinds) == "string"


def type_of(kinds: int | None, digits: int | None = None) -> str:
    """The narrowest type for all kinds of a column; text where none fits, or without any value."""
    if not kinds:
        return "string"
    numbers = INTEGER | LONG | DECIMAL | DOUBLE
    if not kinds & ~numbers:
        if kinds & DOUBLE:
            return "double"
        if kinds & DECIMAL:
            return f"decimal({max(digits or 0, 1)},0)"
        return "bigint" if kinds & LONG else "int"
    if not kinds & ~(DATE | TIMESTAMP):
        return "timestamp" if kinds & TIMESTAMP else "date"
    return "boolean" if kinds == BOOLEAN else "string"


def typed(text: Column, kind: str) -> Column:
    """The text as a value of an inferred type."""
    if kind == "double":  # the suffixes and names that Spark's reader takes, too
        plain = F.regexp_replace(F.trim(text), "[dDfF]$", "")
        named = {"Inf": "Infinity", "-Inf": "-Infinity", "NaN": "NaN", "Infinity": "Infinity", "-Infinity": "-Infinity", "+Infinity": "Infinity"}
        value = F.when(text.rlike(_NUMBER), plain.try_cast("double"))
        for name, full in named.items():
            value = value.when(text == name, F.lit(float(full.replace("Infinity", "inf"))))
        return value
    return text if kind == "string" else text.try_cast(kind)
