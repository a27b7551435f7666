"""Arithmetic with the rounding and edge cases the tables need."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MEBIBYTE = 1_048_576


def ln_ieee(c: Column) -> Column:
    """Natural log with -inf at zero and NaN below it; Spark alone gives null."""
    x = c.cast("double")
    return F.when(x == 0, F.lit(float("-inf"))).when(x < 0, F.lit(float("nan"))).otherwise(F.ln(x))


def mebibytes(delta: Column) -> Column:
    """Bytes to MiB at three decimals, halves to even."""
    return F.bround(delta.cast("double") / F.lit(float(MEBIBYTE)), 3)


def mean_of_milli(c: Column) -> Column:
    """Mean of integer milli-unit readings in units.  The integers are summed
    exactly, so the result does not depend on the order of the rows."""
    return F.sum(c.cast("bigint")).cast("double") / F.nullif(F.count(c) * F.lit(1000.0), F.lit(0.0))
