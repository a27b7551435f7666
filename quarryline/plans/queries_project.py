"""Projections and filters."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from quarryline.datasets.road_collisions import lacking, severity
from quarryline.functions import dates, nulls
from quarryline.functions.text import concat_all
from quarryline.operators import loader
from quarryline.plans.registry import query, table


@query(
    "prj_typed_select",
    """SELECT CAST(l_orderkey AS VARCHAR) AS id, CAST(l_linenumber AS BIGINT) AS line,
        CAST(l_quantity AS INTEGER) AS quantity, CAST(l_shipdate AS DATE) AS shipped,
        TIMESTAMP '2024-11-01 00:00:00' AS datetime_download FROM lineitem""",
)
def prj_typed_select(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("id"),
        F.col("l_linenumber").cast("bigint").alias("line"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_shipdate").cast("date").alias("shipped"),
        F.lit("2024-11-01").cast("timestamp_ntz").alias("datetime_download"),
    )


@query(
    "prj_parallel_columns",
    """SELECT p_partkey, CAST(pow(p_size, 3) AS INTEGER) AS cubes, CAST(pow(p_size, 2) AS INTEGER) AS numbers FROM part""",
)
def prj_parallel_columns(spark, sf):
    parts = table(spark, sf, "part", "p_partkey", "p_size")
    cubes, squares = F.pow("p_size", F.lit(3)).cast("int"), F.pow("p_size", F.lit(2)).cast("int")
    return loader.clean_table(
        parts, column_operations={"cubes": cubes, "p_size": squares}, renames={"p_size": "numbers"}
    )


@query("prj_rename", "SELECT s_suppkey AS id, s_name AS name, s_nationkey, s_acctbal FROM supplier")
def prj_rename(spark, sf):
    return table(spark, sf, "supplier").withColumnsRenamed({"s_suppkey": "id", "s_name": "name"})


@query(
    "prj_literal",
    "SELECT c_custkey, TIMESTAMP '2024-11-01 12:30:00' AS datetime_download FROM customer",
)
def prj_literal(spark, sf):
    as_of = dates.stamp(datetime(2024, 11, 1, 12, 30))
    return table(spark, sf, "customer", "c_custkey").withColumn("datetime_download", as_of)


_SEVERITY = "CASE o_orderstatus WHEN 'F' THEN 'Fatal' WHEN 'O' THEN 'Serious' ELSE 'Slight' END"
_DETAIL = "CASE WHEN o_orderpriority LIKE '1%' THEN NULL ELSE o_orderpriority END"


@query(
    "prj_severity",
    f"""SELECT o_orderkey, CASE WHEN s = 'Serious' AND d IS NOT NULL THEN s || ' - ' || d ELSE s END AS severity
        FROM (SELECT o_orderkey, {_SEVERITY} AS s, {_DETAIL} AS d FROM orders)""",
)
def prj_severity(spark, sf):
    orders = table(spark, sf, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority")
    coded = orders.select(
        "o_orderkey",
        F.expr(_SEVERITY).alias("accident_severity"),
        F.expr(_DETAIL).alias("enhanced_severity_collision"),
    )
    return coded.select("o_orderkey", severity().alias("severity"))


@query(
    "prj_concat_nullprop",
    f"SELECT o_orderkey, o_orderstatus || ' - ' || {_DETAIL} AS label FROM orders",
)
def prj_concat_nullprop(spark, sf):
    orders = table(spark, sf, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority")
    return orders.select("o_orderkey", concat_all(" - ", F.col("o_orderstatus"), F.expr(_DETAIL)).alias("label"))


@query(
    "prj_frame_steps",
    """SELECT l_returnflag AS flag, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
       FROM lineitem WHERE l_discount > 0.02 GROUP BY 1""",
)
def prj_frame_steps(spark, sf):
    steps = [
        lambda df: df.filter("l_discount > 0.02"),
        lambda df: df.groupBy("l_returnflag").agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity")
        ),
        lambda df: df.withColumnRenamed("l_returnflag", "flag"),
    ]
    return loader.apply_in_order(table(spark, sf, "lineitem", "l_returnflag", "l_quantity", "l_discount"), steps)


@query("flt_equality", "SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'")
def flt_equality(spark, sf):
    return table(spark, sf, "events").filter(F.col("event_type") == "purchase").select("event_id", "user_id", "value")


@query(
    "flt_conjunction",
    """SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
       WHERE l_returnflag = 'R' AND l_quantity >= 25 AND l_shipdate >= TIMESTAMP '1997-01-01'""",
)
def flt_conjunction(spark, sf):
    chosen = (
        (F.col("l_returnflag") == "R")
        & (F.col("l_quantity") >= 25)
        & (F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
    )
    return table(spark, sf, "lineitem").filter(chosen).select("l_orderkey", "l_linenumber", "l_extendedprice")


_LAT = "CASE WHEN o_orderpriority LIKE '1%' OR o_orderstatus = 'P' THEN NULL ELSE o_totalprice END"
_LON = "CASE WHEN o_orderpriority LIKE '1%' THEN NULL ELSE o_totalprice END"


@query(
    "flt_nulls",
    f"""SELECT o_orderkey FROM (SELECT o_orderkey, {_LAT} AS latitude, {_LON} AS longitude FROM orders)
        WHERE latitude IS NULL AND longitude IS NULL
        UNION ALL SELECT -o_orderkey FROM (SELECT o_orderkey, {_LAT} AS latitude FROM orders) WHERE latitude IS NOT NULL""",
)
def flt_nulls(spark, sf):
    orders = table(spark, sf, "orders", "o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice")
    placed = orders.select("o_orderkey", F.expr(_LAT).alias("latitude"), F.expr(_LON).alias("longitude"))
    lost = placed.filter(lacking(["latitude", "longitude"])).select("o_orderkey")
    return lost.unionByName(placed.filter(F.col("latitude").isNotNull()).select((-F.col("o_orderkey")).alias("o_orderkey")))


_TERMINATED = "CASE o_orderstatus WHEN 'O' THEN '' WHEN 'P' THEN NULL ELSE strftime(o_orderdate, '%Y%m') END"


@query("flt_empty_flag", f"SELECT o_orderkey, ({_TERMINATED}) = '' AS is_live FROM orders")
def flt_empty_flag(spark, sf):
    orders = table(spark, sf, "orders", "o_orderkey", "o_orderstatus", "o_orderdate")
    ended = (
        F.when(F.col("o_orderstatus") == "O", "")
        .when(F.col("o_orderstatus") == "P", None)
        .otherwise(F.date_format("o_orderdate", "yyyyMM"))
    )
    return orders.select("o_orderkey", nulls.empty_flag(ended).alias("is_live"))
