"""Metric streams over the events: batch forms and real streaming runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarryline.plans.registry import query, table
from quarryline.session import scratch_path
from quarryline.sinks.paths import matching_paths, stamp_in_order
from quarryline.streaming import metrics, stateful, ticks

# A counter in bytes that rises with the event number.
_READING = "event_id * 100000 + CAST(round(value * 100) AS BIGINT) * 1000"
_RATE_SQL = f"""SELECT event_id, user_id, round_even(CAST(r - lag(r) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS DOUBLE) / 1048576.0, 3) AS rate
    FROM (SELECT event_id, user_id, ts, {_READING} AS r FROM events)"""


def _readings(spark, sf):
    events = table(spark, sf, "events", "event_id", "user_id", "ts", "value")
    return events.select("event_id", "user_id", "ts", F.expr(_READING).alias("reading"))


def _as_stream(spark, df, label: str, at: str = "ts", files: int = 6, per_batch: int = 3):
    """The frame as a stream of files, each a range of time, the earliest first and a
    few at a time."""
    path = scratch_path(spark, label)
    df.repartitionByRange(files, at).write.parquet(path)
    stamp_in_order(spark, matching_paths(spark, f"{path}/part-*"))
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    session.conf.set("spark.sql.session.timeZone", "UTC")
    return session.readStream.schema(df.schema).option("maxFilesPerTrigger", per_batch).parquet(path)


def _each_batch(stream, write, label: str) -> None:
    """Hand every micro-batch to ``write``, to the end of the input."""
    check = scratch_path(stream.sparkSession, f"{label}-checkpoint")
    stream.writeStream.foreachBatch(write).option("checkpointLocation", check).trigger(availableNow=True).start().awaitTermination()


def _closed(spark, df, at: str, lateness: str):
    """The frame and one more row past its last tick, which lets the watermark close all others."""
    last = df.agg(F.max(at)).first()[0]
    if last is None:
        return df
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema if f.name != at]
    past = F.lit(last).cast(df.schema[at].dataType) + F.expr(f"INTERVAL {lateness}") + F.expr("INTERVAL 1 DAY")
    return df.unionByName(spark.range(1).select(past.alias(at), *empty))


def _ticks(spark, df, build, label: str):
    """The ticks of a stream over ``df``, all of them given out."""
    target = scratch_path(spark, label)
    stream = _as_stream(spark, _closed(spark, df, "ts", LATENESS), f"{label}-input")
    report = ticks.run_ticks(spark, build(stream), target, f"{target}-checkpoint")
    if report.rows_late:
        raise RuntimeError(f"{report.rows_late} rows came later than {LATENESS}")
    return spark.read.parquet(target).drop(ticks.ROWS).withColumn("tick", F.col("tick").cast("timestamp_ntz"))


LATENESS = "2 HOURS"


@query("st_counter_rate", _RATE_SQL)
def st_counter_rate(spark, sf):
    rated = metrics.counter_rate(_readings(spark, sf), ["user_id"], "ts", "reading", tie="event_id")
    return rated.select("event_id", "user_id", "rate")


@query("st_counter_rate_stream", _RATE_SQL)
def st_counter_rate_stream(spark, sf):
    """The rates of the batch form, from several micro-batches and the last readings kept between them."""
    root = scratch_path(spark, "rates")
    write = stateful.rate_writer(f"{root}/rates", f"{root}/state", ["user_id"], "ts", "reading", "event_id", buckets=8)
    _each_batch(_as_stream(spark, _readings(spark, sf), "readings"), write, "rates")
    return spark.read.parquet(f"{root}/rates").select("event_id", "user_id", "rate")


_MEAN_SQL = """SELECT date_trunc('hour', ts) AS tick, event_type, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS DOUBLE)
        / (count(*) * 1000.0) AS mean FROM events GROUP BY 1, 2"""


def _sensors(spark, sf):
    return table(spark, sf, "events", "ts", "event_type", "props").withColumn("k", F.get_json_object("props", "$.k")).drop("props")


@query("st_sensor_mean", _MEAN_SQL)
def st_sensor_mean(spark, sf):
    events = _sensors(spark, sf)
    return metrics.sensor_mean(events, [F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("tick"), "event_type"], "k")


@query("st_sensor_mean_stream", _MEAN_SQL)
def st_sensor_mean_stream(spark, sf):
    """The same from a stream, each tick given out once its time is over."""

    def means(stream):
        return ticks.sensor_mean_ticks(stream, "ts", "k", "1 hour", LATENESS, ["event_type"])

    events = _sensors(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    return _ticks(spark, events, means, "means")


_METRICS_SQL = """SELECT date_trunc('hour', ts) AS tick, max(value) FILTER (event_type = 'click') AS click, max(value) FILTER (event_type = 'view') AS view,
        max(value) FILTER (event_type = 'error') AS error, strftime(max(ts), '%H:%M:%S') AS timestamp FROM events GROUP BY 1"""


def _metric_names():
    return {"click": None, "view": None, "error": None, "timestamp": F.date_format(F.max("ts"), "HH:mm:ss")}


@query("st_metric_row_stream", _METRICS_SQL)
def st_metric_row_stream(spark, sf):
    """The metric rows from a stream, each given out once its tick is over."""

    def rows(stream):
        return ticks.metric_row_ticks(stream, "ts", "event_type", "value", _metric_names(), "1 hour", LATENESS)

    events = table(spark, sf, "events", "ts", "event_type", "value").withColumn("ts", F.col("ts").cast("timestamp"))
    return _ticks(spark, events, rows, "metric-rows")


@query("st_metric_row", _METRICS_SQL)
def st_metric_row(spark, sf):
    events = table(spark, sf, "events", "ts", "event_type", "value")
    names = _metric_names()
    tick = F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("tick")
    return metrics.metric_row(events, [tick], "event_type", "value", names)


@query(
    "st_latest_snapshot",
    """SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type, max(ts) AS ts
       FROM events GROUP BY user_id""",
)
def st_latest_snapshot(spark, sf):
    """The newest row per user, kept by a stream that adds a delta per batch."""
    columns = ["event_id", "event_type", "ts"]
    state = stateful.snapshot_state(scratch_path(spark, "snapshot"), ["user_id"], ["ts", "event_id"], columns, buckets=8, compact_after=2)
    stream = _as_stream(spark, table(spark, sf, "events", "user_id", *columns), "latest")
    _each_batch(stream, stateful.state_writer(state), "snapshot")
    return state.read(spark)


@query(
    "st_snapshot_json",
    """SELECT user_id, '{"event_id":' || arg_max(event_id, (ts, event_id)) || ',"event_type":"' || arg_max(event_type, (ts, event_id)) || '"}' AS document
       FROM events GROUP BY user_id""",
)
def st_snapshot_json(spark, sf):
    events = table(spark, sf, "events", "user_id", "event_id", "event_type", "ts")
    latest = metrics.latest_state(events, ["user_id"], ["ts", "event_id"], ["event_id", "event_type"])
    return metrics.snapshot_json(latest, ["user_id"])


_LAST_SQL = """SELECT user_id, event_id, ts, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
    FROM events) WHERE rn <= 50"""


@query("st_last_n_buffer", _LAST_SQL)
def st_last_n_buffer(spark, sf):
    events = table(spark, sf, "events", "user_id", "event_id", "ts", "value")
    return metrics.last_n(events, ["user_id"], ["ts", "event_id"])


@query("st_last_n_stream", _LAST_SQL)
def st_last_n_stream(spark, sf):
    """The rows of the batch form, kept as state between batches."""
    columns = ["event_id", "ts", "value"]
    state = stateful.history_state(scratch_path(spark, "history"), ["user_id"], ["ts", "event_id"], columns, buckets=8, compact_after=2)
    stream = _as_stream(spark, table(spark, sf, "events", "user_id", *columns), "points")
    _each_batch(stream, stateful.state_writer(state), "history")
    return state.read(spark)


@query(
    "st_incremental_files",
    "SELECT event_id, event_type, value, CAST(date_trunc('day', ts) AS DATE) AS period FROM events",
)
def st_incremental_files(spark, sf):
    """Two intake runs over the same folder: the second finds nothing new."""
    root = scratch_path(spark, "intake")
    events = table(spark, sf, "events", "event_id", "event_type", "value", "ts")
    events.write.parquet(f"{root}/source")

    def dated(df):
        return df.withColumn("period", F.col("ts").cast("date")).drop("ts")

    for _ in range(2):
        stateful.intake_files(
            spark, f"{root}/source", events.schema, f"{root}/target", f"{root}/checkpoint", "period", dated
        )
    return spark.read.parquet(f"{root}/target")
