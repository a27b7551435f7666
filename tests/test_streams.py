"""Batch and streaming metric operations against direct computation."""

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quarryline.streaming import metrics, stateful, ticks

START = datetime(2024, 1, 1)
SCHEMA = "host string, at timestamp, seq bigint, bytes bigint"


def _readings(n_hosts=3, n=200, seed=1):
    rng, rows = random.Random(seed), []
    for h in range(n_hosts):
        at, total = START, 0
        for i in range(n if h else 3 * n):  # the first host holds most rows
            at += timedelta(minutes=rng.randrange(0, 40))
            total += rng.randrange(0, 9_000_000)
            rows.append((f"h{h}", at, i, total))
    rng.shuffle(rows)
    return rows


def _rates(rows):
    out, last = {}, {}
    for host, at, seq, total in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        out[host, seq] = None if host not in last else round((total - last[host]) / 1048576, 3)
        last[host] = total
    return out


@pytest.mark.parametrize("bucket", ["hour", "day", "year"])
def test_counter_rate(spark, bucket):
    rows = _readings()
    rated = metrics.counter_rate(spark.createDataFrame(rows, SCHEMA), ["host"], "at", "bytes", tie="seq", bucket=bucket)
    assert rated.columns == ["host", "at", "seq", "bytes", "rate"]
    assert {(r["host"], r["seq"]): r["rate"] for r in rated.collect()} == _rates(rows)


def test_counter_rate_orders_a_bucket_at_a_time(spark):
    rated = metrics.counter_rate(spark.createDataFrame(_readings(), SCHEMA), ["host"], "at", "bytes", tie="seq")
    plan = rated._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(host#") >= 1 and "_bucket" in plan and "CartesianProduct" not in plan


def _rate_batches(rows):
    rows = sorted(rows, key=lambda r: (r[1], r[2]))
    third = len(rows) // 3
    return [rows[:third], rows[third : 2 * third], rows[2 * third :]]


def _rates_written(spark, path):
    return {(r["host"], r["seq"]): r["rate"] for r in spark.read.parquet(path).collect()}


@pytest.mark.parametrize("options", [{}, {"buckets": 2, "compact_after": 1}])
def test_rates_of_several_batches(spark, tmp_path, options):
    rows, target = _readings(n=60), str(tmp_path / "rates")
    rows += [(None, START + timedelta(hours=h), 1000 + h, h * 1_000_000) for h in range(90)]  # a series without a name
    write = stateful.rate_writer(target, str(tmp_path / "state"), ["host"], "at", "bytes", "seq", "hour", **options)
    for batch_id, part in enumerate(_rate_batches(rows)):
        for _ in range(2):  # a batch may be run again
            write(spark.createDataFrame(part, SCHEMA), batch_id)
    late = [("h1", START - timedelta(days=1), 999, 5), ("new", START - timedelta(days=1), 1, 5)]
    write(spark.createDataFrame(late, SCHEMA), 3)
    got = _rates_written(spark, target)
    assert got.pop(("h1", 999)) is None and got.pop(("new", 1)) is None
    named = [(h or "", *rest) for h, *rest in rows]
    assert {(h or "", seq): rate for (h, seq), rate in got.items()} == _rates(named)
    write(spark.createDataFrame([], SCHEMA), 4)  # an empty batch
    after = [("h1", START + timedelta(days=400), 2000, 0)]
    write(spark.createDataFrame(after, SCHEMA), 5)
    last = max((r for r in rows if r[0] == "h1"), key=lambda r: (r[1], r[2]))  # the late row did not become the last
    assert _rates_written(spark, target)["h1", 2000] == round(-last[3] / 1048576, 3)


def test_a_hot_series_is_ordered_by_many_tasks(spark, tmp_path):
    rows = [("hot", START + timedelta(minutes=m), m, m * 7919) for m in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    rated = metrics.counter_rate(df, ["host"], "at", "bytes", tie="seq", bucket="hour")
    sizes = [r["count"] for r in rated.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 0.6 * len(rows)
    write = stateful.rate_writer(str(tmp_path / "r"), str(tmp_path / "s"), ["host"], "at", "bytes", "seq", "hour")
    write(df, 0)
    assert len(_rates_written(spark, str(tmp_path / "r"))) == 3000
    assert spark.read.parquet(*map(str, (tmp_path / "s").glob("*-delta"))).count() == 1  # the state is one reading


def test_a_series_starts_anew_after_the_horizon(spark, tmp_path):
    target, state = str(tmp_path / "r"), str(tmp_path / "s")
    write = stateful.rate_writer(target, state, ["host"], "at", "bytes", "seq", horizon="1 DAY", compact_after=1, buckets=1)
    days = [0, 0.5, 3, 3.2, 9]
    for batch_id, day in enumerate(days):
        row = ("h", START + timedelta(days=day), batch_id, 1_048_576 * batch_id)
        other = (f"gone{batch_id}", START + timedelta(days=day), 0, 1)
        write(spark.createDataFrame([row, other], SCHEMA), batch_id)
    got = _rates_written(spark, target)
    assert [got["h", i] for i in range(5)] == [None, 1.0, None, 1.0, None]
    held = stateful.snapshot_state(state, ["host"], ["at", "seq"], ["at", "seq", "bytes"]).read(spark)
    assert {r["host"] for r in held.collect()} == {"h", "gone4"}


def test_last_n(spark):
    rows = _readings()
    kept = metrics.last_n(spark.createDataFrame(rows, SCHEMA), ["host"], ["at", "seq"], 50).collect()
    for host in ("h0", "h1", "h2"):
        want = sorted((r for r in rows if r[0] == host), key=lambda r: (r[1], r[2]))[-50:]
        assert sorted((r["seq"] for r in kept if r["host"] == host)) == sorted(r[2] for r in want)


def test_history_of_several_batches(spark, tmp_path):
    rows = _readings(n=40)
    state = stateful.history_state(str(tmp_path / "h"), ["host"], ["at", "seq"], ["at", "seq", "bytes"], 10, compact_after=2)
    for batch_id in range(6):
        part = rows[batch_id::6]
        state.apply(spark.createDataFrame(part, SCHEMA), batch_id)
        state.apply(spark.createDataFrame(part, SCHEMA), batch_id)
    got = [(r["host"], r["at"], r["seq"], r["bytes"]) for r in state.read(spark).collect()]
    for host in ("h0", "h1", "h2"):
        want = sorted((r for r in rows if r[0] == host), key=lambda r: (r[1], r[2]))[-10:]
        assert sorted((r for r in got if r[0] == host), key=lambda r: (r[1], r[2])) == want


def test_a_hot_series_sends_n_rows_a_task(spark, tmp_path):
    """Rows that reach the task merging a series are bounded by n times the partitions read."""
    df = spark.createDataFrame([("hot", START + timedelta(seconds=i), i, i) for i in range(4000)], SCHEMA).repartition(5)
    plan = metrics.last_n(df, ["host"], ["at", "seq"], 10)._jdf.queryExecution().executedPlan().toString()
    partial, final = plan.index("Partial"), plan.index("Final")
    assert "WindowGroupLimit" in plan and final < plan.rindex("hashpartitioning(host") < partial


def _files(path):
    return {str(p.relative_to(path)) for p in path.glob("*-*/_bucket=*/*.parquet")}


def test_snapshot_of_several_batches(spark, tmp_path):
    path = tmp_path / "snap"

    def state():
        return stateful.snapshot_state(str(path), ["host"], ["at", "seq"], ["at", "seq", "bytes"], buckets=8, compact_after=2, keep=2)

    assert state().read(spark) is None
    many = [(f"k{i}", START, 0, i) for i in range(200)]
    state().apply(spark.createDataFrame(many, SCHEMA), 0)
    assert len({f.split("/")[1] for f in _files(path)}) == 8
    before = _files(path)
    second = spark.createDataFrame([("k7", START + timedelta(1), 2, 11), ("k7", START - timedelta(1), 0, 5)], SCHEMA)
    for _ in range(2):  # a batch may be run again
        state().apply(second, 1)
    added = _files(path) - before
    assert before <= _files(path) and len(added) == 1  # one key: one file of one bucket
    want = {host: b for host, _, _, b in many} | {"k7": 11}
    assert {r["host"]: r["bytes"] for r in state().read(spark).collect()} == want
    bucket = added.pop().split("/")[1]
    for batch_id in (2, 3):
        state().apply(spark.createDataFrame([("k7", START + timedelta(batch_id), 3, 10 + batch_id)], SCHEMA), batch_id)
    state().apply(spark.createDataFrame([("k7", START, 3, 0)], SCHEMA).limit(0), 4)
    after = _files(path)  # its third delta had the bucket rewritten; the others keep their files
    assert {f for f in after if bucket not in f} == {f for f in before if bucket not in f}
    assert {f.split("/")[0] for f in after if bucket in f} == {"000000000002-base", "000000000003-delta"}
    assert {r["host"]: r["bytes"] for r in state().read(spark).collect()} == want | {"k7": 13}
    assert state().read(spark, buckets=[]) is None
    with pytest.raises(ValueError, match="versions"):
        stateful.snapshot_state(str(path), ["host"], ["at"], ["at"], keep=1)


def test_a_batch_stopped_before_its_commit_is_not_seen(spark, tmp_path, monkeypatch):
    state = stateful.snapshot_state(str(tmp_path / "snap"), ["host"], ["at", "seq"], ["at", "seq", "bytes"])
    state.apply(spark.createDataFrame([("a", START, 1, 10)], SCHEMA), 0)

    def stopped(*_):
        raise KeyboardInterrupt

    second = spark.createDataFrame([("a", START + timedelta(1), 2, 11)], SCHEMA)
    with monkeypatch.context() as patch:
        patch.setattr("quarryline.streaming.merged_state.commit_version", stopped)
        with pytest.raises(KeyboardInterrupt):
            state.apply(second, 1)
    assert [r["bytes"] for r in state.read(spark).collect()] == [10]
    state.apply(second, 1)
    assert [r["bytes"] for r in state.read(spark).collect()] == [11]


TICKS = "at timestamp, sensor string, milli bigint"


def _tick_stream(spark, source, rows):
    spark.createDataFrame(rows, TICKS).coalesce(1).write.mode("append").parquet(source)
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", "2")
    return session.readStream.schema(TICKS).option("maxFilesPerTrigger", 1).parquet(source)


def test_ticks_and_late_rows(spark, tmp_path):
    source, target, check = (str(tmp_path / n) for n in ("in", "out", "check"))

    def run(rows):
        stream = _tick_stream(spark, source, rows)
        means = ticks.sensor_mean_ticks(stream, "at", "milli", "1 minute", "2 minutes", ["sensor"])
        return ticks.run_ticks(spark, means, target, check)

    def at(minute, second=0):
        return START + timedelta(minutes=minute, seconds=second)

    first = run([(at(0), "cpu", 41000), (at(0, 30), "cpu", 42500), (at(0, 5), "gpu", None), (at(1), "cpu", 7)])
    assert (first.rows_read, first.rows_emitted, first.rows_open, first.rows_late) == (4, 0, 4, 0)
    # In time for its tick although an hour of others came between; then the watermark moves on.
    second = run([(at(1, 59), "cpu", 9), (at(10), "cpu", 1000)])
    assert (second.rows_read, second.rows_emitted, second.rows_open, second.rows_late) == (6, 5, 1, 0)
    third = run([(at(0, 1), "cpu", 5), (at(0, 2), "cpu", 5), (at(9), "gpu", 3000)])
    assert (third.rows_read, third.rows_emitted, third.rows_open, third.rows_late) == (9, 5, 2, 2)
    got = {(r["tick"], r["sensor"]): (r["mean"], r["n_rows"]) for r in spark.read.parquet(target).collect()}
    assert got == {(at(0), "cpu"): (83500 / 2000, 2), (at(0), "gpu"): (None, 1), (at(1), "cpu"): (16 / 2000, 2)}


def test_state_of_ticks_is_bounded(spark, tmp_path):
    source, target, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    for hour in range(6):
        rows = [(START + timedelta(hours=hour, minutes=m), "cpu", m) for m in range(60)]
        stream = _tick_stream(spark, source, rows)
    wide = ticks.metric_row_ticks(stream, "at", "sensor", "milli", {"cpu": None, "n": F.count("milli")}, "1 minute", "5 minutes")
    report = ticks.run_ticks(spark, wide, target, check)
    assert report.batches >= 6 and report.rows_read == 360 and report.rows_late == 0
    assert report.most_open_ticks <= 60 + 6 and report.rows_open <= 6
    got = {r["tick"]: (r["cpu"], r["n"]) for r in spark.read.parquet(target).collect()}
    assert all(v == (tick.minute, 1) for tick, v in got.items()) and len(got) >= 354


def test_latest_row_as_json(spark):
    df = metrics.latest_state(spark.createDataFrame(_readings(), SCHEMA), ["host"], ["at", "seq"], ["seq", "bytes"])
    documents = {r["host"]: json.loads(r["document"]) for r in metrics.snapshot_json(df, ["host"]).collect()}
    for host, document in documents.items():
        newest = max((r for r in _readings() if r[0] == host), key=lambda r: (r[1], r[2]))
        assert document == {"seq": newest[2], "bytes": newest[3]}


def test_intake_reads_each_file_once(spark, tmp_path):
    source, target, check = (str(tmp_path / n) for n in ("in", "out", "check"))

    def run():
        return stateful.intake_files(
            spark, source, SCHEMA, target, check, "period", lambda df: df.withColumn("period", F.to_date("at"))
        )

    spark.createDataFrame(_readings(n=10), SCHEMA).write.parquet(source)
    assert run() == 1
    n = spark.read.parquet(target).count()
    assert run() == 0
    assert spark.read.parquet(target).count() == n == 50
    spark.createDataFrame([("new", START, 0, 0)], SCHEMA).write.mode("append").parquet(source)
    run()
    assert spark.read.parquet(target).count() == n + 1


def test_sensor_mean_and_metric_row(spark):
    rows = [("t1", "cpu", 41000), ("t1", "cpu", 42500), ("t1", "gpu", 30000), ("t2", "cpu", None)]
    df = spark.createDataFrame(rows, "tick string, sensor string, milli bigint")
    means = {r["tick"]: r["mean"] for r in metrics.sensor_mean(df, ["tick"], "milli").collect()}
    assert means == {"t1": 113500 / 3000, "t2": None}
    wide = metrics.metric_row(df, ["tick"], "sensor", "milli", {"cpu": None, "gpu": None, "n": F.count(F.lit(1))})
    assert sorted(tuple(r) for r in wide.collect()) == [("t1", 42500, 30000, 3), ("t2", None, None, 1)]
