"""Null tokens and sentinels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# The exact strings that mean "missing", per kind of column.
TEXT_NULL_TOKENS = ("null", "NULL", "NONE", "None", "nan", "NaN", "", "-1")
BOOLEAN_NULL_TOKENS = ("null", "none", "nan", "", "-1")


def sentinels_to_null(c: Column, sentinels: Sequence) -> Column:
    """Listed values become null, every other value passes unchanged."""
    return F.when(c.isin(*sentinels), F.lit(None)).otherwise(c)


def text_tokens_to_null(c: Column) -> Column:
    return sentinels_to_null(c, TEXT_NULL_TOKENS)


def empty_flag(c: Column) -> Column:
    """True for an empty string, false for text, null when the field is missing."""
    return c == F.lit("")


def pair_mismatch(a: Column, b: Column) -> Column:
    """True when exactly one of the two is null."""
    return a.isNull() != b.isNull()
