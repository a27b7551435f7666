"""Date helpers; every "today" is an argument."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F

from quarryline.functions.casts import spark_pattern


def stamp(value: datetime | Column) -> Column:
    """A moment without a time zone: the same wall clock under any session zone."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def month_start(c: Column) -> Column:
    return F.trunc(c, "month")


def year_start(c: Column) -> Column:
    return F.trunc(c, "year")


def normalise(c: Column, fmt: str | None = None) -> Column:
    """Midnight timestamp from a number, text, date or timestamp column; a value that
    cannot be read fails the job, null stays null.  Rules as in ``normalise_lenient``."""
    found = normalise_lenient(c, fmt)
    message = F.concat(F.lit("not a date: "), c.cast("string"))
    return F.when(c.isNull(), F.lit(None)).otherwise(F.coalesce(found, F.raise_error(message).cast("timestamp_ntz")))


def normalise_lenient(c: Column, fmt: str | None = None) -> Column:
    """Midnight timestamp, or null for a value that cannot be read.

    Without a format the shapes YYYY, YYYY-MM, YYYYMMDD and ISO dates (with or
    without a time) are told apart by length and pattern.
    """
    text = c.cast("string")
    if fmt is not None:
        return F.try_to_date(text, spark_pattern(fmt)).cast("timestamp_ntz")
    parsed = (
        F.when(text.rlike(r"^\d{4}$"), F.try_to_date(text, "yyyy"))
        .when(text.rlike(r"^\d{4}-\d{2}$"), F.try_to_date(text, "yyyy-MM"))
        .when(text.rlike(r"^\d{8}$"), F.try_to_date(text, "yyyyMMdd"))
        .when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd"))
    )
    return parsed.cast("timestamp_ntz")


def academic_year(c: Column) -> Column:
    """``2019-2020`` for a year end in 2020."""
    return F.concat_ws("-", F.year(c) - 1, F.year(c))


def release_due(newest: Column, as_of: Column) -> Column:
    """True when the newest file postdates 1 October of its own year and the
    as-of date is past 1 October of the next; a missing file is always due."""
    october = F.make_date(F.year(newest), F.lit(10), F.lit(1))
    next_october = F.make_date(F.year(newest) + 1, F.lit(10), F.lit(1))
    return F.coalesce((newest > october) & (as_of > next_october), F.lit(True))
