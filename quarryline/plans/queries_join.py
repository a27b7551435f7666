"""Lookup, unmatched-key, interval and parent/child joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarryline.operators import joins
from quarryline.plans.registry import query, table

_KNOWN = "c_mktsegment <> 'BUILDING'"


@query(
    "join_left_lookup",
    f"""SELECT o_orderkey, o_custkey, c_nationkey, c_acctbal FROM orders
        LEFT JOIN (SELECT * FROM customer WHERE {_KNOWN}) ON o_custkey = c_custkey""",
)
def join_left_lookup(spark, sf):
    customer = table(spark, sf, "customer").filter(_KNOWN).withColumnRenamed("c_custkey", "o_custkey")
    orders = table(spark, sf, "orders", "o_orderkey", "o_custkey")
    return joins.left_lookup(orders, customer, "o_custkey", ["c_nationkey", "c_acctbal"])


@query(
    "join_unmatched_keys",
    f"""SELECT DISTINCT k AS o_custkey FROM (SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS k FROM orders)
        LEFT JOIN (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS a FROM customer WHERE {_KNOWN})
        ON k = c_custkey WHERE a IS NULL""",
)
def join_unmatched_keys(spark, sf):
    """Keys without a row, keys whose attribute is null, and the null key."""
    customer = table(spark, sf, "customer").filter(_KNOWN)
    side = customer.select(
        F.col("c_custkey").alias("o_custkey"), F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance")
    )
    orders = table(spark, sf, "orders", "o_custkey", "o_orderstatus")
    holed = orders.select(F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("o_custkey"))
    return joins.unmatched_keys(holed, side, "o_custkey", "balance")


@query(
    "join_left_two_keys",
    """SELECT c_custkey, c_name, o_custkey, n, total FROM customer LEFT JOIN
        (SELECT o_custkey, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
         FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) ON c_custkey = o_custkey""",
)
def join_left_two_keys(spark, sf):
    counts = table(spark, sf, "orders").filter("o_orderstatus = 'F'").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total")
    )
    return joins.left_two_keys(table(spark, sf, "customer", "c_custkey", "c_name"), counts, "c_custkey", "o_custkey")


_SPANS = {"first": ("1995-06", "1997-04"), "second": ("1997-01", "1998-04"), "third": ("1998-06", "2000-12")}


@query(
    "join_interval_fallback",
    """SELECT o_orderkey, coalesce(label, 'latest') AS archive, label IS NULL AS archive_is_fallback FROM orders LEFT JOIN
        (SELECT m, arg_min(label, seq) AS label FROM (SELECT seq, label, unnest(generate_series(s, e, INTERVAL 1 MONTH)) AS m
          FROM (VALUES (0, 'first', DATE '1995-06-01', DATE '1997-04-01'), (1, 'second', DATE '1997-01-01', DATE '1998-04-01'),
            (2, 'third', DATE '1998-06-01', DATE '2000-12-01')) v(seq, label, s, e)) GROUP BY m)
        ON date_trunc('month', o_orderdate) = m""",
)
def join_interval_fallback(spark, sf):
    orders = table(spark, sf, "orders", "o_orderkey", "o_orderdate")
    spans = joins.inline_intervals(spark, _SPANS)
    return joins.interval_with_fallback(orders, "o_orderdate", spans, "archive").drop("o_orderdate")


@query(
    "join_interval_ranges",
    """SELECT l_orderkey, l_linenumber, coalesce(label, 'latest') AS owner, label IS NULL AS owner_is_fallback FROM lineitem LEFT JOIN
        (SELECT m, arg_min(label, seq) AS label FROM (SELECT o_custkey AS seq, 'c' || o_custkey AS label,
            unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS m
          FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey) GROUP BY m)
        ON date_trunc('month', l_shipdate) = m""",
)
def join_interval_ranges(spark, sf):
    """Intervals that come from a table and overlap: the first one wins."""
    urgent = table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'")
    spans = urgent.groupBy("o_custkey").agg(
        F.min("o_orderdate").cast("date").alias("start"), F.max("o_orderdate").cast("date").alias("end")
    ).select(F.col("o_custkey").alias("seq"), F.concat(F.lit("c"), F.col("o_custkey")).alias("label"), "start", "end")
    lines = table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_shipdate")
    return joins.interval_with_fallback(lines, "l_shipdate", spans, "owner").drop("l_shipdate")


@query(
    "join_parent_child",
    """SELECT l.l_orderkey AS accident_index, CAST(l.l_linenumber AS INTEGER) AS vehicle_reference, o_orderstatus, v.parts,
        l_partkey FROM lineitem l LEFT JOIN orders ON l.l_orderkey = o_orderkey LEFT JOIN
        (SELECT l_orderkey, l_linenumber, count(*) AS parts FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1, 2) v
        ON l.l_orderkey = v.l_orderkey AND l.l_linenumber = v.l_linenumber""",
)
def join_parent_child(spark, sf):
    """Children to their parent and to a sibling table whose reference arrives as text."""
    lines = table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    children = lines.select(
        F.col("l_orderkey").alias("accident_index"), F.col("l_linenumber").alias("vehicle_reference"), "l_partkey"
    )
    parent = table(spark, sf, "orders").select(F.col("o_orderkey").alias("accident_index"), "o_orderstatus")
    sibling = lines.filter("l_returnflag <> 'R'").groupBy(
        F.col("l_orderkey").alias("accident_index"), F.col("l_linenumber").cast("string").alias("vehicle_reference")
    ).agg(F.count(F.lit(1)).alias("parts"))
    keys = ["accident_index", "vehicle_reference"]
    children, sibling = (joins.as_integer_keys(df, ["vehicle_reference"]) for df in (children, sibling))
    return joins.parent_child(children, parent, "accident_index", sibling, keys)
