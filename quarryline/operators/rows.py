"""Ordering, head/tail, sampling and vertical concatenation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from quarryline.functions.codes import ordinal
from quarryline.session import pin


def sort_coded(df: DataFrame, by: Sequence[str], domains: Mapping[str, Sequence] | None = None) -> DataFrame:
    """Ascending sort, nulls first; columns with a declared domain sort in its order."""
    domains = domains or {}
    keys = [ordinal(F.col(c), domains[c]) if c in domains else F.col(c) for c in by]
    return df.orderBy(*[k.asc_nulls_first() for k in keys])


def place_in_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], output: str = "place"
) -> DataFrame:
    """Adds each row's place (from 1) within its group; ``order`` must leave no ties.

    Rows are dealt to ranges of group and order and pinned there.  The rows of a
    group before each of its ranges come from counts, a row for each group and
    range, so only a range's share of a group is ever ordered by one task.
    """
    # Structs compare and join null-safely, so the null group finds its own rows.
    group = F.struct(F.lit(0).alias("_all"), *[F.col(k) for k in keys])
    ranked = df.withColumns({"_group": group, "_order": F.struct(*order)})
    dealt = pin(ranked.repartitionByRange("_group", "_order").withColumn("_range", F.spark_partition_id()))
    counts = dealt.groupBy("_group", "_range").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_group").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    inner = Window.partitionBy("_group", "_range").orderBy("_order")
    placed = dealt.join(before, ["_group", "_range"]).withColumn(output, (F.col("_before") + F.row_number().over(inner)).cast("long"))
    return placed.drop("_group", "_order", "_range", "_before")


def head(df: DataFrame, by: Sequence[str], n: int = 5) -> DataFrame:
    return df.orderBy(*by).limit(n)


def tail(df: DataFrame, by: Sequence[str], n: int = 5) -> DataFrame:
    """Last ``n`` rows in the given order (returned last first)."""
    return df.orderBy(*[F.col(c).desc() for c in by]).limit(n)


def sample_rows(df: DataFrame, key: Column, n: int, seed: int = 0) -> DataFrame:
    """``n`` rows chosen by a seeded digest of a key: repeatable on any partitioning."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), key.cast("string")).cast("binary"))
    return df.orderBy(digest, key).limit(n)


def concat_same(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames of one schema; a differing schema is an error."""
    first = frames[0]
    wanted = dict(first.dtypes)
    out = first
    for frame in frames[1:]:
        if dict(frame.dtypes) != wanted:
            raise ValueError(f"schemas differ: {first.dtypes} and {frame.dtypes}")
        out = out.unionByName(frame)
    return out


def concat_wide(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames over the union of their columns; absent ones are null."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
