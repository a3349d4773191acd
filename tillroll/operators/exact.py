"""Sums of doubles that no task order can change, of any size.

A double is a whole number of at most 53 bits times a power of two. On a fixed grid of
limbs of 32 bits it fills at most three neighbouring limbs. Limbs are whole numbers, so
their sums are exact, merge in any order and grouping, and are kept as rows: a partial
sum today and another tomorrow add up to the sum of all. The total is rounded to a
double once, at the end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 32
_BASE = 1 << BITS
_LIMBS = ("l0", "l1", "l2")  # of the highest limb that a value fills, and the two below
_COUNTS = ("n", "n_nan", "n_up", "n_down")  # values, and those among them without a finite value
STATE = ("limb", *_LIMBS, *_COUNTS)


def _scaled(value: Column, limbs: Column) -> Column:
    """`value` times 2 to the power of `BITS` * `limbs`, exactly; in two steps, as one could overflow."""
    half = F.pow(F.lit(2.0), limbs * (BITS // 2))
    return value * half * half


def sum_states(df: DataFrame, keys: Sequence[str], value: str, **also: Column) -> DataFrame:
    """Partial sums of `value`: a row per key and limb, `keys, limb, l0, l1, l2, n, ...`.

    Nulls are no values; a key with none but nulls has a state, with n = 0. `also` names
    whole numbers to be summed next to it, such as `lines=F.lit(1)`.
    """
    rows = df.select(*keys, *(c.alias(n) for n, c in also.items()), F.col(value).cast("double").alias("x"))
    x = F.col("x")
    finite = x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    rows = rows.withColumn("left", F.when(finite, x).otherwise(0.0))
    size = F.when(F.col("left") != 0, F.abs("left"))
    rows = rows.withColumn("limb", F.floor(F.log2(size) / BITS).cast("int"))
    # the logarithm is rounded, so it may be one off next to a border
    scaled = _scaled(size, -F.col("limb"))
    limb = F.col("limb") - F.when(scaled < 1, 1).otherwise(0) + F.when(scaled >= _BASE, 1).otherwise(0)
    rows = rows.withColumn("limb", F.coalesce(limb, F.lit(0)))
    rows = rows.withColumn("left", _scaled(F.col("left"), -F.col("limb")))
    for name in _LIMBS:
        rows = rows.withColumn(name, F.when(F.col("left") < 0, F.ceil("left")).otherwise(F.floor("left")))
        rows = rows.withColumn("left", (F.col("left") - F.col(name)) * _BASE)
    inf = F.lit(float("inf"))
    counts = {"n": F.col("x").isNotNull(), "n_nan": F.isnan("x"), "n_up": F.col("x") == inf, "n_down": F.col("x") == -inf}
    # a limb may be summed over more rows than 31 bits count, so the sums are wide
    return rows.groupBy(*keys, "limb").agg(
        *(F.sum(F.col(p).cast("decimal(20,0)")).cast("decimal(38,0)").alias(p) for p in _LIMBS),
        *(F.sum(F.coalesce(c.cast("long"), F.lit(0))).alias(n) for n, c in counts.items()),
        *(F.sum(n).alias(n) for n in also),
    )


def merge_states(states: DataFrame, keys: Sequence[str], also: Sequence[str] = ()) -> DataFrame:
    """States of fewer keys, or of several batches, added up."""
    return states.groupBy(*keys, "limb").agg(
        *(F.sum(p).cast("decimal(38,0)").alias(p) for p in _LIMBS), *(F.sum(n).alias(n) for n in (*_COUNTS, *also))
    )


def _carried(values: Column) -> Column:
    """Whole numbers from the lowest limb up as digits from 0 to 2^32 - 1, and the carry beyond."""
    zero = F.lit(0).cast("decimal(38,0)")
    start = F.struct(zero.alias("carry"), F.array().cast("array<decimal(38,0)>").alias("digits"))

    def step(so_far: Column, value: Column) -> Column:
        total = (so_far["carry"] + value).cast("decimal(38,0)")
        digit = F.pmod(total, F.lit(_BASE).cast("decimal(38,0)")).cast("decimal(38,0)")
        carry = F.call_function("div", (total - digit).cast("decimal(38,0)"), F.lit(_BASE).cast("decimal(38,0)"))
        return F.struct(
            carry.cast("decimal(38,0)").alias("carry"),
            F.concat(so_far["digits"], F.array(digit)).alias("digits"),
        )

    return F.aggregate(values, start, step)


def totals(states: DataFrame, keys: Sequence[str], name: str, also: Sequence[str] = ()) -> DataFrame:
    """`keys, name`: the sums of all values behind the states, each the double nearest to the exact sum.

    As with a plain sum, no value gives null, a NaN or both infinities give NaN, and a sum
    beyond the largest double is infinite. `n` counts the values.
    """
    merged = merge_states(states, keys, also)
    member = F.struct("limb", *_LIMBS)
    grouped = merged.groupBy(*keys).agg(
        F.collect_list(member).alias("limbs"),  # a row per limb: 67 at most
        *(F.sum(n).alias(n) for n in (*_COUNTS, *also)),
    )
    zero = F.lit(0).cast("decimal(38,0)")
    low, high = F.array_min("limbs.limb") - 2, F.array_max("limbs.limb")
    by_limb = F.map_from_entries(F.transform("limbs", lambda s: F.struct(s["limb"].alias("k"), s.alias("v"))))
    grouped = grouped.withColumns({"low": low, "high": high, "by_limb": by_limb})

    def at(limb: Column) -> Column:
        parts = [F.coalesce(F.try_element_at("by_limb", limb + i)[p], zero) for i, p in enumerate(_LIMBS)]
        return (parts[0] + parts[1] + parts[2]).cast("decimal(38,0)")

    # three limbs above the highest hold any carry
    values = F.transform(F.sequence("low", F.col("high") + 3), at)
    grouped = grouped.withColumn("values", values).withColumn("signed", _carried(F.col("values")))
    negative = F.col("signed.carry") < 0
    turned = F.when(negative, F.transform("values", lambda v: -v)).otherwise(F.col("values"))
    grouped = grouped.withColumns({"negative": negative, "digits": _carried(turned)["digits"]})
    # The highest digit that is not 0 and the two below it, then whether anything lies below those.
    places = F.filter(F.transform("digits", lambda d, i: F.when(d > 0, i)), lambda i: i.isNotNull())
    grouped = grouped.withColumn("top", F.coalesce(F.array_max(places), F.lit(0)))
    base = F.lit(_BASE).cast("decimal(10,0)")

    def digit(below: int) -> Column:
        return F.coalesce(F.when(F.col("top") >= below, F.get("digits", F.col("top") - below)), zero)

    rest = F.exists("digits", lambda d: d > 0) & (F.col("top") > 2)
    lower = F.slice("digits", F.lit(1), F.greatest(F.col("top") - 2, F.lit(0)))
    sticky = F.when(rest & F.exists(lower, lambda d: d > 0), 1).otherwise(0)
    two = F.lit(2).cast("decimal(1,0)")
    head = (((digit(0) * base + digit(1)).cast("decimal(38,0)") * base + digit(2)).cast("decimal(38,0)") * two).cast("decimal(38,0)")
    # doubled, so that what lies below is a last bit that decides ties
    size = _scaled((head + sticky).cast("double") / 2, F.col("top") - 2 + F.col("low"))
    total = (
        F.when(F.col("n") == 0, F.lit(None).cast("double"))
        .when((F.col("n_nan") > 0) | ((F.col("n_up") > 0) & (F.col("n_down") > 0)), float("nan"))
        .when(F.col("n_up") > 0, float("inf"))
        .when(F.col("n_down") > 0, float("-inf"))
        .when(F.col("negative"), -size)
        .otherwise(size)
    )
    return grouped.select(*keys, total.alias(name), "n", *also)
