"""Structured Streaming forms: keyed state, snapshots and once-only file intake."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from quarryline.sinks.paths import matching_paths
from quarryline.streaming.merged_state import MergedState
from quarryline.streaming.metrics import HISTORY, counter_rate, last_n, latest_state


def snapshot_state(path: str, keys: Sequence[str], at: Sequence[str], columns: Sequence[str], **options) -> MergedState:
    """State that is the newest row per key."""

    def newest(rows: DataFrame) -> DataFrame:
        return latest_state(rows, keys, at, columns)

    return MergedState(path, keys, newest, **options)


def history_state(
    path: str, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], n: int = HISTORY, **options
) -> MergedState:
    """State that is the last ``n`` rows per key; ``order`` must leave no ties between
    different rows.  Each task keeps its own last ``n`` of a key before the shuffle, so
    a hot series brings no more than ``n`` rows from every task to the one that merges."""

    def last(rows: DataFrame) -> DataFrame:
        return last_n(rows.select(*keys, *columns), keys, order, n)

    return MergedState(path, keys, last, **options)


def state_writer(state: MergedState) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that adds each batch to a state."""
    return lambda batch, batch_id: state.apply(batch, batch_id)


def rate_writer(
    target: str,
    path: str,
    keys: Sequence[str],
    at: str,
    reading: str,
    tie: str,
    bucket: str = "day",
    horizon: str | None = None,
    output: str = "rate",
    **options,
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that writes the counter rates of each batch under ``target``.

    The state under ``path`` is the last reading of each series.  A batch reads it for
    the buckets its keys fall in, and hands each series its last reading as one more
    row of the batch form, which orders a series a time bucket at a time: a hot series
    is spread over as many tasks as it has buckets in the batch, and only its last
    readings go on to the next batch.  A reading older than the last one of an earlier
    batch is late: its rate is null and the state stays.  A series without a reading
    for ``horizon`` starts anew, and goes when its state bucket is rewritten.
    """
    order = [at, tie]
    state = snapshot_state(path, keys, order, [*order, reading], **options)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.persist()
        try:
            buckets = [r[0] for r in rows.select(state.bucket()).distinct().collect()]
            held = state.read(spark, batch_id, buckets)
            late = None
            timely = rows.withColumn("_held", F.lit(False))
            if held is not None:
                met = held.select(*[F.col(c).alias(f"_key_{c}") for c in keys], F.struct(*order).alias("_last"))
                same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_key_{c}")) for c in keys])
                seen = rows.join(met, same, "left").drop(*[f"_key_{c}" for c in keys])
                is_late = F.coalesce(F.struct(*order) < F.col("_last"), F.lit(False))
                late = seen.filter(is_late).drop("_last").withColumn(output, F.lit(None).cast("double"))
                timely = seen.filter(~is_late).drop("_last").withColumn("_held", F.lit(False))
                named = rows.select(*[F.col(c).alias(f"_key_{c}") for c in keys]).distinct()
                carried = held.join(named, same, "left_semi").withColumn("_held", F.lit(True))
                timely = timely.unionByName(carried, allowMissingColumns=True)
            rated = counter_rate(timely, keys, at, reading, tie, bucket, output, horizon).filter(~F.col("_held")).drop("_held")
            rated = rated if late is None else rated.unionByName(late)
            rated.write.mode("overwrite").parquet(f"{target}/batch={batch_id:012d}")
            alive = None
            if horizon is not None and (newest := rows.agg(F.max(at)).first()[0]) is not None:
                alive = F.col(at) + F.expr(f"INTERVAL {horizon}") >= F.lit(newest).cast(rows.schema[at].dataType)
            # The newest reading wins in the state, so late rows change nothing there.
            state.apply(rows.select(*keys, *order, reading), batch_id, alive)
        finally:
            rows.unpersist()

    return write


def intake_files(
    spark: SparkSession,
    source: str,
    schema: StructType | str,
    target: str,
    checkpoint: str,
    period: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
    fmt: str = "parquet",
    **options,
) -> int:
    """Process every file of ``source`` not processed before and append the rows to
    the period-partitioned ``target``; returns the number of batches run."""
    before = _last_batch(spark, checkpoint)
    stream = spark.readStream.format(fmt).schema(schema).options(**options).load(source)
    query = (
        prepare(stream)
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .partitionBy(period)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return _last_batch(spark, checkpoint) - before


def _last_batch(spark: SparkSession, checkpoint: str) -> int:
    """Number of the last committed batch, -1 before the first; Spark keeps only the latest progress reports."""
    return max((int(p.rsplit("/", 1)[1]) for p in matching_paths(spark, f"{checkpoint}/commits/[0-9]*")), default=-1)

