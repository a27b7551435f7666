"""Lookup joins, unmatched-key reports, interval and parent/child joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from quarryline.sources.literal import literal_table


def left_lookup(df: DataFrame, dimension: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Left equi-join on one key with the right side projected first.  Null keys
    never match; a key repeated on the right repeats the row."""
    return df.join(dimension.select(key, *columns), key, "left")


def left_two_keys(left: DataFrame, right: DataFrame, left_on: str, right_on: str) -> DataFrame:
    """Left join on differently named keys; both keys stay."""
    return left.join(right, left[left_on] == right[right_on], "left")


def unmatched_keys(df: DataFrame, dimension: DataFrame, key: str, attribute: str) -> DataFrame:
    """Distinct keys (a null key included) for which the joined attribute is null:
    no dimension row, or one whose attribute is itself null."""
    keys = df.select(key).distinct()
    side = dimension.select(F.col(key).alias("_k"), F.col(attribute).alias("_a"))
    joined = keys.join(side, keys[key] == F.col("_k"), "left")
    return joined.filter(F.col("_a").isNull()).select(key).distinct()


def month_lookup(intervals: DataFrame, start: str, end: str, label: str, order: str) -> DataFrame:
    """One row per month covered by any interval, the first interval in ``order``
    winning.  Turns an interval join into an equi-join on the month."""
    months = F.explode(F.sequence(F.trunc(start, "month"), F.trunc(end, "month"), F.expr("interval 1 month")))
    covered = intervals.filter(F.col(start) <= F.col(end)).select(
        months.alias("_month"), F.col(label).alias("_label"), F.col(order).alias("_at")
    )
    return covered.groupBy("_month").agg(F.min_by("_label", "_at").alias("_label"))


def interval_with_fallback(
    df: DataFrame,
    month: str,
    intervals: DataFrame,
    output: str,
    *,
    start: str = "start",
    end: str = "end",
    label: str = "label",
    order: str = "seq",
    fallback: str = "latest",
) -> DataFrame:
    """Adds the label of the interval holding each row's month, else ``fallback``,
    and ``<output>_is_fallback`` so rows outside every interval can be seen."""
    side = month_lookup(intervals, start, end, label, order)
    joined = df.join(side, F.trunc(month, "month") == F.col("_month"), "left")
    return joined.withColumns(
        {
            output: F.coalesce("_label", F.lit(fallback)),
            f"{output}_is_fallback": F.col("_label").isNull(),
        }
    ).drop("_month", "_label")


def parent_child(
    children: DataFrame,
    parent: DataFrame,
    key: str,
    sibling: DataFrame | None = None,
    sibling_key: Sequence[str] = (),
) -> DataFrame:
    """Children left-joined to their parent, and to a sibling table on a wider key."""
    joined = children.join(parent, key, "left")
    return joined if sibling is None else joined.join(sibling, list(sibling_key), "left")


def as_integer_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Reference columns as integers, so both sides of a join agree in type."""
    return df.withColumns({c: F.col(c).try_cast("int") for c in columns})


def inline_intervals(spark, rows: Mapping[str, tuple[str, str]]) -> DataFrame:
    """``label -> (start, end)`` as the small interval table the join expects."""
    data = [(i, label, *span) for i, (label, span) in enumerate(rows.items())]
    frame = literal_table(spark, data, "seq int, label string, start string, end string")
    return frame.withColumns({c: F.to_date(c, "yyyy-MM") for c in ("start", "end")})
