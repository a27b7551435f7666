"""Exact order statistics against brute force."""

import math
import random
import statistics

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from quarryline.operators import orderstats

QS = (0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0)


def _nearest(values, q):
    values = sorted(values)
    return values[math.floor((len(values) - 1) * q + 0.5)] if values else None


def _check(spark, rows):
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r["k"]: r for r in orderstats.quantiles_nearest(df, ["k"], "v", QS).collect()}
    groups = {}
    for k, v in rows:
        groups.setdefault(k, []).extend([] if v is None else [v])
    assert set(got) == set(groups)
    for k, values in groups.items():
        for q in QS:
            assert got[k][f"v_q{q:.2f}"] == _nearest(values, q), (k, q)


def test_quantiles(spark):
    rng = random.Random(1)
    rows = [("hot", rng.gauss(0, 1)) for _ in range(4000)]
    rows += [("ties", float(rng.randrange(5))) for _ in range(900)]
    rows += [(None, rng.random()) for _ in range(300)] + [("one", 7.0), ("none", None), ("two", 1.0), ("two", 2.0)]
    rows += [("hot", None)] * 10
    rng.shuffle(rows)
    _check(spark, rows)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.floats(-1e6, 1e6))), min_size=1, max_size=200))
def test_quantiles_of_anything(spark, rows):
    rows = [(k, None if v is None else v + 0.0) for k, v in rows]
    _check(spark, rows)


def test_median(spark):
    rng = random.Random(2)
    rows = [(k, rng.expovariate(1)) for k, n in (("odd", 301), ("even", 300), ("one", 1)) for _ in range(n)]
    df = spark.createDataFrame(rows, "k string, v double")
    found = orderstats.median_by(df, ["k"], "v", "m").collect()
    for r in found:
        assert r["m"] == statistics.median(v for k, v in rows if k == r["k"])


def test_no_keys(spark):
    df = spark.createDataFrame([(v,) for v in (4.0, 1.0, None, 3.0)], "v double")
    assert [tuple(r) for r in orderstats.quantiles_nearest(df, [], "v", (0.0, 0.5, 1.0)).collect()] == [(1.0, 3.0, 4.0)]


def test_a_hot_group_is_spread(spark):
    """A group's values lie in many ranges, and only ranges with a wanted rank are ordered."""
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        counted = spark.range(40_000).selectExpr("struct('x' AS k) AS _group", "CAST(id AS DOUBLE) AS _v", "1L AS _c")
        dealt = counted.repartitionByRange(16, "_group", "_v").withColumn("_range", F.spark_partition_id())
        ranges = orderstats._ranges(dealt, [orderstats.nearest("m", 0.5)])
        assert ranges.count() == 16 and ranges.filter("_holds_rank").count() == 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
