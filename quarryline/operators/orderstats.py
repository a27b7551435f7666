"""Exact order statistics per group: nearest-rank quantiles and medians.

Spark's ``percentile`` and ``median`` keep every distinct value of a group in
one task, and ``percentile_approx`` is not exact.  Here values are counted per
(group, value), the counts are dealt to ranges of (group, value), and each
range's sum gives the running count at which the next range of the group starts.
Only the ranges that hold a wanted rank are then ordered.  A group of any size
is spread over as many ranges as its values need, and the plan is the same at
every size.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F

from quarryline.functions.maths import ln_ieee
from quarryline.session import pin

QUARTILES_AND_TAILS = (0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95)


@dataclass(frozen=True)
class Rank:
    """A wanted output and its exact 0-based rank among n."""

    name: str
    rank: Callable[[Column], Column]


def nearest(name: str, q: float) -> Rank:
    """Nearest rank, halves away from zero."""
    return Rank(name, lambda n: F.floor((n - 1) * F.lit(float(q)) + 0.5))


def order_statistics(df: DataFrame, keys: Sequence[str], value: str, ranks: Sequence[Rank]) -> DataFrame:
    """One row per group (a null key is a group) with the exact value at each rank.

    Null values are not counted; a group without values yields nulls.  The input
    is read once, when this is called; the counts are pinned with their range.
    """
    # Structs compare and join null-safely, so the null group finds its own rows.
    group = F.struct(F.lit(0).alias("_all"), *[F.col(k) for k in keys]).alias("_group")
    counted = df.select(group, F.col(value).alias("_v")).groupBy("_group", "_v").agg(F.count("_v").alias("_c"))
    dealt = pin(counted.repartitionByRange("_group", "_v").withColumn("_range", F.spark_partition_id()))

    wanted = _ranges(dealt, ranks).filter("_n = 0 or _holds_rank")
    inner = Window.partitionBy("_group", "_range").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    running = dealt.join(wanted, ["_group", "_range"]).withColumn("_upto", F.col("_before") + F.sum("_c").over(inner))
    outputs = []
    for r in ranks:
        at = r.rank(F.col("_n"))
        hit = (F.col("_upto") - F.col("_c") <= at) & (at < F.col("_upto"))
        outputs.append(F.max(F.when(hit, F.col("_v"))).alias(r.name))
    found = running.groupBy("_group").agg(*outputs)
    return found.select(*[F.col("_group")[k].alias(k) for k in keys], *[f"`{r.name}`" for r in ranks])


def _ranges(dealt: DataFrame, ranks: Sequence[Rank]) -> DataFrame:
    """A row for each range a group touches: values before it, values of the group,
    and whether a wanted rank lies in it.  There are as many as groups and ranges together."""
    sums = dealt.groupBy("_group", "_range").agg(F.sum("_c").alias("_sum"))
    group = Window.partitionBy("_group")
    upto = F.sum("_sum").over(group.orderBy("_range").rowsBetween(Window.unboundedPreceding, 0))
    placed = sums.withColumns({"_before": upto - F.col("_sum"), "_n": F.sum("_sum").over(group)})
    at = [r.rank(F.col("_n")) for r in ranks]
    held = reduce(or_, [(F.col("_before") <= a) & (a < F.col("_before") + F.col("_sum")) for a in at])
    return placed.withColumn("_holds_rank", held).drop("_sum")


def quantiles_nearest(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    quantiles: Sequence[float] = QUARTILES_AND_TAILS,
) -> DataFrame:
    """Columns ``<value>_q0.05`` and so on, exact, per group."""
    ranks = [nearest(f"{value}_q{q:.2f}", q) for q in quantiles]
    return order_statistics(df, keys, value, ranks)


def median_by(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Mean of the two middle values, exact, per group."""
    middle = [
        Rank("_low", lambda n: F.floor((n - 1) / 2)),
        Rank("_high", lambda n: F.floor(n / 2)),
    ]
    found = order_statistics(df, keys, value, middle)
    return found.select(*keys, ((F.col("_low") + F.col("_high")) / 2).alias(name))


def log_median(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    return median_by(df, keys, value, name).withColumn(name, ln_ieee(F.col(name)))
