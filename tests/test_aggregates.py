"""Aggregates on literal rows, nulls and empty groups included."""

import random

import pytest
from pyspark.sql import functions as F

from quarryline.operators import aggregates, calendars, joins, rows


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_sum_of_nothing_is_zero(spark):
    df = spark.createDataFrame([("a", None), ("b", 2), ("b", None)], "k string, v int")
    total = df.groupBy("k").agg(aggregates.sum_or_zero(F.col("v"), "int").alias("v"))
    assert total.dtypes == [("k", "string"), ("v", "int")] and _rows(total) == [("a", 0), ("b", 2)]


def test_null_is_a_group(spark):
    df = spark.createDataFrame([("a",), (None,), (None,)], "k string")
    assert _rows(aggregates.row_count(df, ["k"])) == [("a", 1), (None, 2)]


def test_counts_by_category_keep_real_nulls(spark):
    df = spark.createDataFrame([(1, "x", None), (1, "x", "q"), (2, None, "q")], "p int, a string, b string")
    got = _rows(aggregates.row_count_by_category(df, "p", ["a", "b"]))
    assert got == sorted([(1, "a", "x", 2), (2, "a", None, 1), (1, "b", None, 1), (1, "b", "q", 1), (2, "b", "q", 1)], key=str)


def test_bins(spark):
    df = spark.createDataFrame([(0.0, 5), (6.0, 5), (5.9, 5), (3.0, None), (None, 5)], "v double, c int")
    got = aggregates.equal_width_bins(df, {"v": "bin", "c": "flat"}, 6).collect()
    assert [r["bin"] for r in got] == [1, 6, 6, 4, None]
    assert [r["flat"] for r in got] == [1, 1, 1, None, 1]


def test_bins_read_their_ends_once(spark):
    df = spark.range(100).selectExpr("id AS a", "id * 2 AS b")
    plan = aggregates.equal_width_bins(df, {"a": "x", "b": "y"}, 4)._jdf.queryExecution().optimizedPlan().toString()
    assert "CartesianProduct" not in plan and plan.count("Join") == 0


def test_share_of_an_empty_table(spark):
    df = spark.createDataFrame([], "v int")
    assert tuple(aggregates.share(df, {"big": F.col("v") > 1}).first()) == (0, 0, None)


def test_category_order(spark):
    counts = spark.createDataFrame([("f", "b", 2), ("f", "a", 2), ("f", "c", 9), ("g", "z", None)], "f string, c string, len int")
    ranked = aggregates.category_order(counts, "f", "c").collect()
    assert {(r["f"], r["c"]): r["rank"] for r in ranked} == {("f", "c"): 1, ("f", "a"): 2, ("f", "b"): 3, ("g", "z"): 1}


def test_unmatched_keys(spark):
    left = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), (None,)], "k string")
    right = spark.createDataFrame([("a", 1), ("b", None)], "k string, v int")
    assert _rows(joins.unmatched_keys(left, right, "k", "v")) == [("b",), ("c",), (None,)]


def test_lookup_repeats_rows_for_repeated_keys(spark):
    left = spark.createDataFrame([("a",), (None,)], "k string")
    right = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "k string, v int")
    assert _rows(joins.left_lookup(left, right, "k", ["v"])) == [("a", 1), ("a", 2), (None, None)]


def test_concat(spark):
    a = spark.createDataFrame([(1, "x")], "n int, t string")
    b = spark.createDataFrame([("x", 1)], "t string, n int")
    assert _rows(rows.concat_same([a, b])) == [(1, "x"), (1, "x")]
    with pytest.raises(ValueError, match="schemas differ"):
        rows.concat_same([a, a.withColumn("n", F.col("n").cast("bigint"))])
    wide = rows.concat_wide([a, spark.createDataFrame([(True,)], "flag boolean")])
    assert _rows(wide) == sorted([(1, "x", None), (None, None, True)], key=str)


def test_sample_does_not_depend_on_partitions(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    one, other = (rows.sample_rows(df.repartition(n), F.col("k"), 10, seed=3).collect() for n in (1, 7))
    assert sorted(one) == sorted(other) and len(set(one)) == 10
    assert sorted(rows.sample_rows(df, F.col("k"), 10, seed=4).collect()) != sorted(one)


def test_places_in_a_hot_group(spark):
    """Places equal sorted order; the hot group's rows are ordered in many ranges."""
    rng = random.Random(3)
    rows_in = [(rng.choice(["hot", "hot", "hot", "a", None]), rng.choice([None, 1, 2, 3]), i) for i in range(4000)]
    df = spark.createDataFrame(rows_in, "k string, v int, i int").repartition(6)
    placed = rows.place_in_group(df, ["k"], [F.col("v"), F.col("i")])
    assert placed.columns == ["k", "v", "i", "place"]
    got = {r["i"]: r["place"] for r in placed.collect()}
    for k in ("hot", "a", None):
        mine = sorted((r for r in rows_in if r[0] == k), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        assert [got[r[2]] for r in mine] == list(range(1, len(mine) + 1))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # or few rows make one range
    try:
        placed = rows.place_in_group(df, ["k"], [F.col("v"), F.col("i")])
        assert {r["i"]: r["place"] for r in placed.collect()} == got
        sizes = placed.where("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()
        assert len(sizes) > 2 and max(r["count"] for r in sizes) < 1500
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert rows.place_in_group(df.limit(0), ["k"], [F.col("i")]).count() == 0


def test_coded_sort_puts_nulls_first(spark):
    df = spark.createDataFrame([("high",), ("low",), (None,), ("mid",)], "v string")
    assert [r[0] for r in rows.sort_coded(df, ["v"], {"v": ("low", "mid", "high")}).collect()] == [None, "low", "mid", "high"]


@pytest.mark.parametrize(("total", "size", "expected"), [(0, 5, []), (5, 5, [(0, 1, 5, "0")]), (6, 5, [(0, 1, 5, "0"), (1, 6, 6, "1")])])
def test_chunks(spark, total, size, expected):
    df = spark.createDataFrame([(total,)], "n bigint")
    got = calendars.chunks(df, F.col("n"), size).select("chunk", "id_start", "id_end", "label")
    assert _rows(got) == expected


def test_chunk_labels_are_padded_to_the_number_of_chunks(spark):
    df = spark.createDataFrame([(10,), (100,)], "n bigint")
    labels = {(r["n"], r["chunk"]): r["label"] for r in calendars.chunks(df, F.col("n"), 1).collect()}
    assert labels[10, 3] == "03" and labels[100, 3] == "003" and labels[100, 99] == "099"


def test_spines(spark):
    df = spark.createDataFrame([("2019-05-06", "2021-02-01"), ("2021-02-01", "2019-01-01")], "a string, b string")
    found = calendars.years(df, F.col("a"), F.col("b")).select("period")
    assert [str(r[0]) for r in found.orderBy("period").collect()] == ["2019-01-01", "2020-01-01", "2021-01-01"]
    assert calendars.months(df, F.col("a"), F.col("b")).count() == 22
    assert calendars.without(found, "period", ["2020-01-01"]).count() == 2
