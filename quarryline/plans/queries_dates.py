"""Calendars, period starts and date parsing."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarryline.functions import casts, dates
from quarryline.operators import calendars
from quarryline.plans.registry import query, table

_SPAN = "(SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders)"


def _span(spark, sf, *keys):
    return table(spark, sf, "orders", *keys, "o_orderdate").groupBy(*keys).agg(
        F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi")
    )


@query(
    "cal_years",
    f"SELECT CAST(unnest(generate_series(date_trunc('year', lo), hi, INTERVAL 1 YEAR)) AS DATE) AS period FROM {_SPAN}",
)
def cal_years(spark, sf):
    return calendars.years(_span(spark, sf), F.col("lo"), F.col("hi")).select("period")


@query(
    "cal_months",
    """SELECT o_custkey, CAST(unnest(generate_series(date_trunc('month', lo), hi - INTERVAL 6 MONTH, INTERVAL 1 MONTH)) AS DATE) AS period
       FROM (SELECT o_custkey, min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders GROUP BY 1)""",
)
def cal_months(spark, sf):
    """Every month a customer was active, up to six months before the last order."""
    span = _span(spark, sf, "o_custkey")
    return calendars.months(span, F.col("lo"), F.add_months("hi", -6)).select("o_custkey", "period")


@query(
    "cal_years_excluding",
    f"""SELECT * FROM (SELECT CAST(unnest(generate_series(date_trunc('year', lo), hi - INTERVAL 1 YEAR, INTERVAL 1 YEAR)) AS DATE) AS period
        FROM {_SPAN}) WHERE period NOT IN (DATE '1995-01-01', DATE '1998-01-01')""",
)
def cal_years_excluding(spark, sf):
    spine = calendars.years(_span(spark, sf), F.col("lo"), F.add_months("hi", -12))
    return calendars.without(spine, "period", ["1995-01-01", "1998-01-01"]).select("period")


@query("cal_month_start", "SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders")
def cal_month_start(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", dates.month_start(F.col("o_orderdate")).alias("month"))


@query("cal_year_start", "SELECT o_orderkey, CAST(date_trunc('year', o_orderdate) AS DATE) AS year FROM orders")
def cal_year_start(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", dates.year_start(F.col("o_orderdate")).alias("year"))


@query(
    "cal_parse_strict",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS minute, CAST(date_trunc('month', o_orderdate) AS DATE) AS dashed,
        CAST(date_trunc('month', o_orderdate) AS DATE) AS compact FROM orders""",
)
def cal_parse_strict(spark, sf):
    orders = table(spark, sf, "orders", "o_orderkey", "o_orderdate")
    at = F.col("o_orderdate")
    return orders.select(
        "o_orderkey",
        casts.strict_date(F.date_format(at, "yyyy-MM-dd HH:mm"), "%Y-%m-%d %H:%M").alias("minute"),
        casts.strict_date(F.date_format(at, "yyyy-MM"), "%Y-%m").alias("dashed"),
        casts.strict_date(F.date_format(at, "yyyyMM"), "%Y%m").alias("compact"),
    )


@query(
    "cal_parse_lenient",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN CAST(date_trunc('month', o_orderdate) AS DATE) END AS ended
       FROM orders""",
)
def cal_parse_lenient(spark, sf):
    """Open-ended termination months: blank and unreadable ones are null."""
    orders = table(spark, sf, "orders", "o_orderkey", "o_orderstatus", "o_orderdate")
    written = (
        F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyyMM"))
        .when(F.col("o_orderstatus") == "O", F.lit(""))
        .otherwise(F.lit("202213"))
    )
    return orders.select("o_orderkey", casts.clean_date(written, "%Y%m").alias("ended"))


@query(
    "cal_normalise",
    """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN date_trunc('year', o_orderdate) WHEN 1 THEN date_trunc('month', o_orderdate)
        WHEN 4 THEN NULL ELSE date_trunc('day', o_orderdate) END AS at FROM orders""",
)
def cal_normalise(spark, sf):
    orders = table(spark, sf, "orders", "o_orderkey", "o_orderdate")
    at, kind = F.col("o_orderdate"), F.col("o_orderkey") % 5
    written = (
        F.when(kind == 0, F.date_format(at, "yyyy"))
        .when(kind == 1, F.date_format(at, "yyyy-MM"))
        .when(kind == 2, F.date_format(at, "yyyyMMdd"))
        .when(kind == 3, F.date_format(at, "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.lit("soon"))
    )
    return orders.select("o_orderkey", dates.normalise_lenient(written).alias("at"))


@query(
    "cal_normalise_strict",
    """SELECT o_orderkey, CASE o_orderkey % 2 WHEN 0 THEN date_trunc('month', o_orderdate) ELSE date_trunc('day', o_orderdate) END AS at FROM orders""",
)
def cal_normalise_strict(spark, sf):
    orders = table(spark, sf, "orders", "o_orderkey", "o_orderdate")
    written = F.date_format("o_orderdate", "yyyy-MM")
    daily = F.date_format("o_orderdate", "yyyyMMdd")
    return orders.select("o_orderkey", dates.normalise(F.when(F.col("o_orderkey") % 2 == 0, written).otherwise(daily)).alias("at"))


@query(
    "cal_academic_year",
    "SELECT o_orderkey, (year(o_orderdate) - 1) || '-' || year(o_orderdate) AS span FROM orders",
)
def cal_academic_year(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", dates.academic_year(F.col("o_orderdate")).alias("span"))
