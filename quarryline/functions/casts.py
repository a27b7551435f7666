"""Strict and lenient casts with the rules a cleaned table promises.

Spark's own casts trim blanks and accept Java number suffixes (``1.5d``); a
cleaned table must not, so numbers pass a pattern first.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from quarryline.functions.nulls import BOOLEAN_NULL_TOKENS, sentinels_to_null, text_tokens_to_null

INTEGER_PATTERN = r"^[+-]?[0-9]+$"
FLOAT_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$|^[+-]?([nN][aA][nN]|[iI][nN][fF])$"

# Parts of strftime formats and the pattern letters Spark reads for them.
_STRFTIME = {"%Y": "yyyy", "%m": "MM", "%d": "dd", "%H": "HH", "%M": "mm", "%S": "ss", "%b": "MMM"}


_SHAPES = {
    "yyyy": r"[0-9]{4}",
    "MMM": r"[A-Za-z]{3}",
    "MM": r"(0[1-9]|1[0-2])",
    "dd": r"(0[1-9]|[12][0-9]|3[01])",
    "HH": r"([01][0-9]|2[0-3])",
    "mm": r"[0-5][0-9]",
    "ss": r"[0-5][0-9]",
}


def spark_pattern(fmt: str) -> str:
    """``%d/%m/%Y`` and ``dd/MM/yyyy`` are both accepted; the latter is returned."""
    for part, letters in _STRFTIME.items():
        fmt = fmt.replace(part, letters)
    if "%" in fmt:
        raise ValueError(f"unsupported date format part in {fmt!r}")
    return fmt


def strict(c: Column, dtype: str) -> Column:
    """Cast that fails the job on a bad value (text with blanks around counts as bad),
    whether or not the session casts strictly by itself."""
    return _or_fail(lenient(c, dtype), c, dtype)


def _or_fail(value: Column, c: Column, what: str) -> Column:
    message = F.concat(F.lit(f"not a valid {what}: "), c.cast("string"))
    return F.coalesce(value, F.when(c.isNotNull(), F.raise_error(message)))


def lenient(c: Column, dtype: str) -> Column:
    """Cast that turns a bad value into null."""
    pattern = _number_pattern(dtype)
    if pattern is None:
        return c.try_cast(dtype)
    text = c.cast("string")
    return F.when(text.rlike(pattern), c.try_cast(dtype))


def _number_pattern(dtype: str) -> str | None:
    if dtype in ("tinyint", "smallint", "int", "integer", "bigint", "long"):
        return INTEGER_PATTERN
    if dtype in ("float", "double"):
        return FLOAT_PATTERN
    return None


def clean_string(c: Column) -> Column:
    return text_tokens_to_null(c.cast("string"))


def clean_boolean(c: Column) -> Column:
    """Tokens (any case) to null, true/false to 1/0, then a strict integer whose
    non-zero values are true."""
    text = sentinels_to_null(F.lower(c.cast("string")), BOOLEAN_NULL_TOKENS)
    digits = F.when(text == "true", F.lit("1")).when(text == "false", F.lit("0")).otherwise(text)
    return strict(digits, "int").cast("boolean")


def _shape(fmt: str) -> str:
    """Pattern of text a format can read.  Text of another shape is passed over
    before parsing: a failed parse costs far more than the test, and cleaned
    columns hold many blanks."""
    shape = re.escape(spark_pattern(fmt))
    for letters, digits in _SHAPES.items():
        shape = shape.replace(letters, digits)
    return f"^{shape}$"


def clean_date(c: Column, fmt: str) -> Column:
    """Lenient date by one format; anything unreadable is null."""
    return F.when(c.rlike(_shape(fmt)), F.try_to_date(c, spark_pattern(fmt)))


def strict_date(c: Column, fmt: str) -> Column:
    """Date by one format; unreadable text fails the job."""
    return _or_fail(F.try_to_date(c, spark_pattern(fmt)), c, f"date ({fmt})")


def clean_time(c: Column, fmt: str) -> Column:
    """Lenient time of day, held as ``HH:mm:ss`` text."""
    text = text_tokens_to_null(c)
    stamp = F.try_to_timestamp(
        F.concat(F.lit("1970-01-01 "), text), F.lit("yyyy-MM-dd " + spark_pattern(fmt))
    )
    return F.when(text.rlike(_shape(fmt)), F.date_format(stamp, "HH:mm:ss"))
