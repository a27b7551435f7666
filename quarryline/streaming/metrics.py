"""Batch forms of the metric operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from quarryline.functions.maths import mean_of_milli, mebibytes

HISTORY = 50


def counter_rate(
    df: DataFrame,
    keys: Sequence[str],
    at: str,
    reading: str,
    tie: str | None = None,
    bucket: str = "day",
    output: str = "rate",
    horizon: str | None = None,
) -> DataFrame:
    """Difference from the previous reading of the same series, in MiB at 3 decimals;
    null where the previous reading is older than ``horizon`` (an interval).

    A series is cut into time buckets, so even one that holds a third of all
    rows is ordered by many tasks.  Each bucket is handed the last reading of
    the one before it as an extra row, which is dropped again.  That costs one
    small aggregate; rows are shuffled once.
    """
    order = [at] if tie is None else [at, tie]
    rows = df.withColumns({"_bucket": F.date_trunc(bucket, F.col(at)), "_carried": F.lit(False)})
    last = rows.groupBy(*keys, "_bucket").agg(
        F.max_by(F.struct(*order, reading), F.struct(*order)).alias("_last")
    )
    following = F.lead("_bucket").over(Window.partitionBy(*keys).orderBy("_bucket"))
    carried = last.withColumn("_next", following).filter(F.col("_next").isNotNull()).select(
        *keys,
        *[F.col(f"_last.{c}").alias(c) for c in [*order, reading]],
        F.col("_next").alias("_bucket"),
        F.lit(True).alias("_carried"),
    )
    both = rows.unionByName(carried, allowMissingColumns=True)
    window = Window.partitionBy(*keys, "_bucket").orderBy(F.col("_carried").desc(), *order)
    rate = mebibytes(F.col(reading) - F.lag(reading).over(window))
    if horizon is not None:
        rate = F.when(F.lag(at).over(window) + F.expr(f"INTERVAL {horizon}") >= F.col(at), rate)
    rated = both.withColumn(output, rate)
    return rated.filter(~F.col("_carried")).drop("_bucket", "_carried")


def sensor_mean(df: DataFrame, keys: Sequence[str | Column], milli: str, output: str = "mean") -> DataFrame:
    """Mean over the sensors of a tick, milli-units to units."""
    return df.groupBy(*keys).agg(mean_of_milli(F.col(milli)).alias(output))


def metric_row(
    df: DataFrame, keys: Sequence[str | Column], metric: str, value: str, names: Mapping[str, Column | None]
) -> DataFrame:
    """One wide row per tick: ``output -> aggregate`` (default: the metric of that name)."""
    outputs = [
        (F.max(F.when(F.col(metric) == name, F.col(value))) if agg is None else agg).alias(name)
        for name, agg in names.items()
    ]
    return df.groupBy(*keys).agg(*outputs)


def latest_state(df: DataFrame, keys: Sequence[str], at: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The newest row per key; combined on the map side, so a hot key is cheap."""
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*columns), F.struct(*at)).alias("_s"))
    return newest.select(*keys, *[F.col(f"_s.{c}").alias(c) for c in columns])


def last_n(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int = HISTORY) -> DataFrame:
    """The last ``n`` rows of each series; every task keeps only its own ``n`` per
    series before the shuffle (the optimizer's group limit)."""
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") <= n).drop("_rn")


def snapshot_json(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One JSON document per key."""
    rest = [c for c in df.columns if c not in keys]
    return df.select(*keys, F.to_json(F.struct(*rest), {"ignoreNullFields": "false"}).alias("document"))
