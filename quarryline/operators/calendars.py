"""Period spines: every year or month a backfill must cover.

A spine starts from a frame that holds the range (one row, or one row per
series), so it also works for ranges computed from data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def years(df: DataFrame, start: Column, end: Column, output: str = "period") -> DataFrame:
    first, last = F.trunc(start.cast("date"), "year"), F.trunc(end.cast("date"), "year")
    spine = F.sequence(first, last, F.expr("interval 1 year"))
    return df.withColumn(output, F.explode(F.when(first <= last, spine)))


def months(df: DataFrame, start: Column, end: Column, output: str = "period") -> DataFrame:
    first, last = F.trunc(start.cast("date"), "month"), F.trunc(end.cast("date"), "month")
    spine = F.sequence(first, last, F.expr("interval 1 month"))
    return df.withColumn(output, F.explode(F.when(first <= last, spine)))


def without(df: DataFrame, column: str, excluded: Sequence[str]) -> DataFrame:
    """Drop listed periods (ISO dates)."""
    dates = [F.lit(d).cast("date") for d in excluded]
    return df.filter(~F.col(column).isin(*dates))


def chunks(df: DataFrame, total: Column, size: int) -> DataFrame:
    """Ids 1..total cut into consecutive ranges of at most ``size``.

    Adds ``chunk`` (from 0), ``id_start``, ``id_end`` and ``label``, the chunk
    number padded to the width of the number of chunks.
    """
    last = F.ceil(total / F.lit(size)).cast("bigint") - 1
    spread = df.withColumns({"_total": total.cast("bigint"), "_last": last}).filter(F.col("_last") >= 0)
    spread = spread.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_last"))))
    width = F.length((F.col("_last") + 1).cast("string"))
    number = F.col("chunk").cast("string")
    return spread.withColumns(
        {
            "id_start": F.col("chunk") * size + 1,
            "id_end": F.least((F.col("chunk") + 1) * size, F.col("_total")),
            "label": F.lpad(number, F.greatest(width, F.length(number)), F.lit("0")),
        }
    ).drop("_total", "_last")
