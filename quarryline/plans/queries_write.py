"""Queries over landing: partitioned writes, missing periods, manifests."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarryline.datasets import boundaries, price_paid
from quarryline.functions.dates import release_due, year_start
from quarryline.operators import calendars
from quarryline.plans.registry import query, table
from quarryline.session import scratch_path
from quarryline.sinks import landing


@query("snk_roundtrip", "SELECT * FROM orders")
def snk_roundtrip(spark, sf):
    path = scratch_path(spark, "roundtrip")
    landing.write_table(table(spark, sf, "orders"), path)
    return spark.read.parquet(path)


@query(
    "snk_partitioned",
    """SELECT o_orderkey, o_totalprice, CAST(date_trunc('year', o_orderdate) AS DATE) AS period
       FROM orders WHERE year(o_orderdate) = 1997""",
)
def snk_partitioned(spark, sf):
    path = scratch_path(spark, "periods")
    orders = table(spark, sf, "orders", "o_orderkey", "o_totalprice", "o_orderdate")
    yearly = orders.withColumn("period", year_start(F.col("o_orderdate"))).drop("o_orderdate")
    landing.write_periods(yearly, path, "period")
    return spark.read.parquet(path).filter("period = DATE '1997-01-01'")


@query(
    "snk_missing_periods",
    """SELECT CAST(date_trunc('year', o_orderdate) AS DATE) AS period, count(*) AS n,
        year(o_orderdate) >= 1998 AS landed_late FROM orders GROUP BY 1, 3""",
)
def snk_missing_periods(spark, sf):
    """Land the years before 1998, then every year: only the later ones are written."""
    path = scratch_path(spark, "backfill")
    orders = table(spark, sf, "orders", "o_orderkey", "o_orderdate")
    rows = orders.withColumn("period", year_start(F.col("o_orderdate")))
    span = rows.agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
    wanted = calendars.years(span, F.col("lo"), F.col("hi"))
    early = "period < DATE '1998-01-01'"
    landing.land(rows.filter(early), wanted.filter(early), path, "period")
    late = landing.land(rows, wanted, path, "period").withColumn("late", F.lit(True))
    counted = spark.read.parquet(path).groupBy("period").agg(F.count(F.lit(1)).alias("n"))
    return counted.join(late, "period", "left").select(
        "period", "n", F.coalesce("late", F.lit(False)).alias("landed_late")
    )


@query(
    "snk_outside_calendar",
    """SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(date_trunc('year', o_orderdate) AS DATE) END AS period
       FROM orders WHERE o_orderpriority = '5-LOW' OR year(o_orderdate) = 1995""",
)
def snk_outside_calendar(spark, sf):
    """Rows without a period, and of a year that the calendar leaves out."""
    orders = table(spark, sf, "orders", "o_orderkey", "o_orderdate", "o_orderpriority")
    dated = F.when(F.col("o_orderpriority") != "5-LOW", year_start(F.col("o_orderdate")))
    span = orders.agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
    wanted = calendars.years(span, F.col("lo"), F.col("hi")).filter("year(period) <> 1995")
    return landing.outside_calendar(orders.select("o_orderkey", dated.alias("period")), wanted, "period").select("o_orderkey", "period")


@query("snk_complete", "SELECT c_custkey, c_acctbal FROM customer")
def snk_complete(spark, sf):
    path = scratch_path(spark, "complete")
    landing.write_table(table(spark, sf, "customer", "c_custkey", "c_acctbal"), path)
    return landing.read_complete(spark, path)


@query(
    "snk_release_gate",
    """SELECT o_custkey, newest, newest > make_timestamp(year(newest), 10, 1, 0, 0, 0)
        AND TIMESTAMP '2001-12-01' > make_timestamp(year(newest) + 1, 10, 1, 0, 0, 0) AS due
       FROM (SELECT o_custkey, max(o_orderdate) AS newest FROM orders GROUP BY o_custkey)""",
)
def snk_release_gate(spark, sf):
    newest = table(spark, sf, "orders", "o_custkey", "o_orderdate").groupBy("o_custkey").agg(
        F.max("o_orderdate").alias("newest")
    )
    as_of = F.lit("2001-12-01").cast("timestamp_ntz")
    return newest.withColumn("due", release_due(F.col("newest"), as_of))


@query(
    "snk_chunks",
    """WITH c AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1),
        k AS (SELECT event_type, n, unnest(range(0, CAST(ceil(n / 50.0) AS BIGINT))) AS chunk,
              CAST(ceil(n / 50.0) AS BIGINT) AS chunks FROM c)
       SELECT event_type, n, chunk, chunk * 50 + 1 AS id_start, least((chunk + 1) * 50, n) AS id_end,
        lpad(CAST(chunk AS VARCHAR), CAST(length(CAST(chunks AS VARCHAR)) AS INTEGER), '0') AS label FROM k""",
)
def snk_chunks(spark, sf):
    counts = table(spark, sf, "events", "event_type").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return calendars.chunks(counts, F.col("n"), 50)


@query(
    "snk_layer_manifest",
    """WITH c AS (SELECT count(*) AS n FROM customer),
        k AS (SELECT n, unnest(range(0, CAST(ceil(n / 200.0) AS BIGINT))) AS chunk FROM c)
       SELECT chunk, 'root/Wards_May_2024_Boundaries_UK_BFE/FeatureServer/0/query?outFields=*&where=1%3D1+AND+OBJECTID+BETWEEN+'
        || (chunk * 200 + 1) || '+AND+' || least((chunk + 1) * 200, n) || '&f=geojson' AS url,
        'boundaries_wd_may_2024_uk_bfc.' || lpad(CAST(chunk AS VARCHAR),
            CAST(length(CAST(CAST(ceil(n / 200.0) AS BIGINT) AS VARCHAR)) AS INTEGER), '0') || '.geojson' AS file_name FROM k""",
)
def snk_layer_manifest(spark, sf):
    counts = table(spark, sf, "customer", "c_custkey").agg(F.count(F.lit(1)).alias("count"))
    layer = boundaries.CATALOGUE["WD_MAY_2024_UK_BFC"]
    return boundaries.chunk_manifest(counts, layer, "root").select("chunk", "url", "file_name")


@query(
    "snk_manifest",
    """WITH s AS (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders),
        y AS (SELECT unnest(generate_series(date_trunc('year', lo), hi, INTERVAL 1 YEAR)) AS p FROM s)
       SELECT CAST(p AS DATE) AS period, 'pp-' || year(p) || '.csv' AS file_name,
        'http://example.org/pp-' || year(p) || '.csv' AS url FROM y""",
)
def snk_manifest(spark, sf):
    span = table(spark, sf, "orders", "o_orderdate").agg(
        F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi")
    )
    return price_paid.manifest(calendars.years(span, F.col("lo"), F.col("hi")), "http://example.org")
