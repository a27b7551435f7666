"""Tick aggregates of a stream: event-time windows, a watermark and counted late rows.

A tick is given out once, whole, when the watermark passes its end (append mode); its
state is dropped then, so state holds the ticks of one ``lateness`` only.  A row of a
tick given out before is late and is left out.  Every tick carries the number of its
rows, so the late ones are known exactly: rows read, less those in ticks given out,
less those in ticks still open.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DecimalType, StructField, StructType

from quarryline.functions.maths import mean_of_milli
from quarryline.sinks.paths import exists

ROWS = "n_rows"
COUNTED = DecimalType(30, 0)


def tick_aggregate(
    stream: DataFrame, at: str, width: str, lateness: str, keys: Sequence[str], outputs: Sequence[Column]
) -> DataFrame:
    """One row per tick and key: ``tick`` (its start), the keys, the outputs, ``n_rows``."""
    timed = stream.withWatermark(at, lateness).groupBy(F.window(at, width).alias("_window"), *keys)
    counted = F.sum(F.lit(1).cast("decimal(20,0)")).cast("long")
    ticks = timed.agg(*outputs, counted.alias(ROWS))
    return ticks.select(F.col("_window.start").alias("tick"), *[c for c in ticks.columns if c != "_window"])


def sensor_mean_ticks(
    stream: DataFrame, at: str, milli: str, width: str, lateness: str, keys: Sequence[str] = (), output: str = "mean"
) -> DataFrame:
    """Mean over the sensors of each tick, milli-units to units."""
    return tick_aggregate(stream, at, width, lateness, keys, [mean_of_milli(F.col(milli)).alias(output)])


def metric_row_ticks(
    stream: DataFrame, at: str, metric: str, value: str, names: Mapping[str, Column | None], width: str, lateness: str
) -> DataFrame:
    """One wide row per tick: ``output -> aggregate`` (default: the greatest value of the metric of that name)."""
    outputs = [
        (F.max(F.when(F.col(metric) == name, F.col(value))) if agg is None else agg).alias(name)
        for name, agg in names.items()
    ]
    return tick_aggregate(stream, at, width, lateness, [], outputs)


@dataclass(frozen=True)
class TickReport:
    """What became of the rows of a stream so far."""

    rows_read: int
    rows_emitted: int
    rows_open: int
    batches: int
    most_open_ticks: int  # state rows held at once, over the batches of this run

    @property
    def rows_late(self) -> int:
        return self.rows_read - self.rows_emitted - self.rows_open


def run_ticks(spark: SparkSession, ticks: DataFrame, target: str, checkpoint: str) -> TickReport:
    """Run a tick stream to the end of its input into the table ``target``.

    The rows read by each batch are kept beside the checkpoint, so the report covers
    all runs on it; a run that was stopped before its end is counted by the next.
    """
    conf = ticks.sparkSession.conf
    conf.set("spark.sql.streaming.numRecentProgressUpdates", "100000")
    writer = ticks.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    query = writer.format("parquet").start(target)
    query.awaitTermination()
    ledger = f"{checkpoint}-rows"
    progress = [(p["batchId"], p["numInputRows"], sum(s["numRowsTotal"] for s in p["stateOperators"])) for p in query.recentProgress]
    if progress:
        spark.createDataFrame(progress, "batch long, rows long, open long").coalesce(1).write.mode("append").parquet(ledger)
    # A batch can report twice, with and without rows.
    read = spark.read.parquet(ledger).groupBy("batch").agg(F.max("rows").alias("rows")) if exists(spark, ledger) else None
    total = read.agg(F.sum("rows"), F.count("*")).first() if read is not None else (0, 0)
    emitted = spark.read.parquet(target).agg(F.sum(ROWS)).first()[0] or 0
    return TickReport(total[0] or 0, emitted, open_rows(spark, ticks, checkpoint), total[1], max((p[2] for p in progress), default=0))


def open_rows(spark: SparkSession, ticks: DataFrame, checkpoint: str) -> int:
    """Rows in ticks not given out yet, from the state of the aggregation.

    Names of its buffers can repeat and their order is Spark's own; the count of rows
    is known by its type, a sum of decimals no other output should have."""
    state = spark.read.format("statestore").load(checkpoint)
    buffers = state.schema["value"].dataType.fields
    (at,) = (i for i, f in enumerate(buffers) if f.dataType == COUNTED)
    numbered = StructType([StructField(f"b{i}", f.dataType) for i, f in enumerate(buffers)])
    return int(state.agg(F.sum(F.col("value").cast(numbered)[f"b{at}"])).first()[0] or 0)
