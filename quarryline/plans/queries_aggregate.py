"""Counts, shares, exact quantiles, bins, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarryline.functions.codes import ordinal, recode_strict
from quarryline.functions.dates import month_start, year_start
from quarryline.operators import aggregates, joins, orderstats, rows
from quarryline.plans.registry import query, table

STATUS = {"F": "fulfilled", "O": "open", "P": "pending"}
QUANTILES = orderstats.QUARTILES_AND_TAILS


def _nearest(value: str, q: float, name: str) -> str:
    return (
        f"list_extract(list_sort(list({value})), CAST(floor((count({value}) - 1) * CAST({q} AS DOUBLE) + 0.5) AS INTEGER) + 1)"
        f" AS \"{name}_q{q:.2f}\""
    )


_QUANTILE_SQL = ", ".join(_nearest("o_totalprice", q, "price") for q in QUANTILES)


@query(
    "agg_len",
    "SELECT CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS segment, count(*) AS len FROM customer GROUP BY 1",
)
def agg_len(spark, sf):
    customer = table(spark, sf, "customer", "c_acctbal", "c_mktsegment")
    segment = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("segment")
    return aggregates.row_count(customer.select(segment), ["segment"])


@query(
    "agg_len_by_category",
    " UNION ALL ".join(
        f"SELECT CAST(date_trunc('year', l_shipdate) AS DATE) AS year, '{c}' AS category, CAST({c} AS VARCHAR) AS value, count(*) AS len FROM lineitem GROUP BY 1, 3"
        for c in ("l_returnflag", "l_linestatus", "l_linenumber")
    ),
)
def agg_len_by_category(spark, sf):
    lines = table(spark, sf, "lineitem", "l_shipdate", "l_returnflag", "l_linestatus", "l_linenumber")
    dated = lines.withColumn("year", year_start(F.col("l_shipdate")))
    return aggregates.row_count_by_category(dated, "year", ["l_returnflag", "l_linestatus", "l_linenumber"])


@query(
    "agg_count_nonnull",
    """SELECT o_orderpriority, count(CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END) AS n FROM orders GROUP BY 1""",
)
def agg_count_nonnull(spark, sf):
    orders = table(spark, sf, "orders", "o_orderpriority", "o_orderstatus", "o_orderkey")
    return orders.groupBy("o_orderpriority").agg(
        F.count(F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey"))).alias("n")
    )


@query(
    "agg_sum_zero",
    """SELECT p_brand, CAST(coalesce(sum(CASE WHEN p_brand = 'Brand#11' THEN NULL ELSE p_size END), 0) AS INTEGER) AS size
       FROM part GROUP BY 1""",
)
def agg_sum_zero(spark, sf):
    parts = table(spark, sf, "part", "p_brand", "p_size")
    size = F.when(F.col("p_brand") != "Brand#11", F.col("p_size"))
    return parts.groupBy("p_brand").agg(aggregates.sum_or_zero(size, "int").alias("size"))


@query(
    "agg_multi",
    """SELECT l_suppkey, count(l_orderkey) AS accidents, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS casualties,
        CAST(sum(l_linenumber) AS BIGINT) AS vehicles FROM lineitem WHERE l_suppkey IS NOT NULL GROUP BY 1""",
)
def agg_multi(spark, sf):
    lines = table(spark, sf, "lineitem", "l_suppkey", "l_orderkey", "l_quantity", "l_linenumber")
    return lines.filter(F.col("l_suppkey").isNotNull()).groupBy("l_suppkey").agg(
        F.count("l_orderkey").alias("accidents"),
        aggregates.sum_or_zero(F.col("l_quantity").cast("bigint")).alias("casualties"),
        aggregates.sum_or_zero(F.col("l_linenumber")).alias("vehicles"),
    )


@query(
    "agg_quantiles_nearest",
    f"SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, {_QUANTILE_SQL} FROM orders GROUP BY 1",
)
def agg_quantiles_nearest(spark, sf):
    orders = table(spark, sf, "orders", "o_orderdate", "o_totalprice")
    dated = orders.select(month_start(F.col("o_orderdate")).alias("month"), F.col("o_totalprice").alias("price"))
    return orderstats.quantiles_nearest(dated, ["month"], "price", QUANTILES).orderBy("month")


def price_quantiles_by_status(spark, sf):
    """Orders with their customer's nation: quantiles of price per month and status,
    in month order and then in the order the status labels are declared."""
    orders = table(spark, sf, "orders", "o_orderdate", "o_custkey", "o_totalprice", "o_orderstatus")
    customer = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    placed = joins.left_lookup(orders, customer, "o_custkey", ["c_nationkey"])
    dated = placed.select(
        month_start(F.col("o_orderdate")).alias("month"),
        recode_strict(F.col("o_orderstatus"), STATUS, "status").alias("status"),
        F.when(F.col("c_nationkey").isNotNull(), F.col("o_totalprice")).alias("price"),
    )
    found = orderstats.quantiles_nearest(dated, ["month", "status"], "price", QUANTILES)
    return rows.sort_coded(found, ["month", "status"], {"status": tuple(STATUS.values())})


@query(
    "agg_quantiles_two_keys",
    f"""SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
        CASE o_orderstatus WHEN 'F' THEN 'fulfilled' WHEN 'O' THEN 'open' WHEN 'P' THEN 'pending' END AS status, {_QUANTILE_SQL}
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""",
)
def agg_quantiles_two_keys(spark, sf):
    return price_quantiles_by_status(spark, sf)


@query(
    "agg_quantiles_hot_group",
    """SELECT k AS kind, """
    + ", ".join(_nearest("v", q, "v") for q in (0.05, 0.5, 0.95))
    + """ FROM (SELECT CASE WHEN l_returnflag = 'R' THEN NULL ELSE 'x' END AS k, l_extendedprice AS v FROM lineitem) GROUP BY 1""",
)
def agg_quantiles_hot_group(spark, sf):
    """Two huge groups, forced through the sketch-and-bracket plan."""
    lines = table(spark, sf, "lineitem", "l_returnflag", "l_extendedprice")
    kinds = lines.select(
        F.when(F.col("l_returnflag") != "R", F.lit("x")).alias("kind"), F.col("l_extendedprice").alias("v")
    )
    return orderstats.quantiles_nearest(kinds, ["kind"], "v", (0.05, 0.5, 0.95))


@query(
    "agg_log_median",
    """SELECT year, c_nationkey, round(ln(median(o_totalprice)), 9) AS price FROM (
        SELECT CAST(date_trunc('year', o_orderdate) AS DATE) AS year, c_nationkey, o_totalprice FROM orders
        JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'F' AND c_mktsegment = 'MACHINERY') GROUP BY 1, 2""",
)
def agg_log_median(spark, sf):
    orders = table(spark, sf, "orders").filter("o_orderstatus = 'F'")
    customer = table(spark, sf, "customer").filter("c_mktsegment = 'MACHINERY'")
    sold = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        year_start(F.col("o_orderdate")).alias("year"), "c_nationkey", "o_totalprice"
    )
    found = orderstats.log_median(sold, ["year", "c_nationkey"], "o_totalprice", "price")
    return found.withColumn("price", F.round("price", 9)).orderBy("year")


@query(
    "agg_expr_keys",
    """SELECT year(o_orderdate) AS year_int, CAST(year(o_orderdate) AS VARCHAR) AS year, o_orderstatus, count(o_orderkey) AS count
       FROM orders GROUP BY 1, 2, 3""",
)
def agg_expr_keys(spark, sf):
    orders = table(spark, sf, "orders").withColumn("y", F.year("o_orderdate"))
    return (
        orders.groupBy(F.col("y").alias("year_int"), F.col("y").cast("string").alias("year"), F.col("o_orderstatus"))
        .agg(F.count("o_orderkey").alias("count"))
        .orderBy("year_int")
    )


@query("agg_distinct", "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
def agg_distinct(spark, sf):
    return table(spark, sf, "customer", "c_nationkey", "c_mktsegment").distinct()


@query(
    "agg_share",
    """SELECT count(*) AS n_total, count(*) FILTER (o_orderstatus = 'P') AS n_pending,
        CAST(count(*) FILTER (o_orderstatus = 'P') AS DOUBLE) / count(*) AS share_pending,
        count(*) FILTER (o_orderstatus = 'P' AND o_orderpriority = '5-LOW') AS n_low,
        CAST(count(*) FILTER (o_orderstatus = 'P' AND o_orderpriority = '5-LOW') AS DOUBLE) / count(*) AS share_low FROM orders""",
)
def agg_share(spark, sf):
    pending = F.col("o_orderstatus") == "P"
    predicates = {"pending": pending, "low": pending & (F.col("o_orderpriority") == "5-LOW")}
    return aggregates.share(table(spark, sf, "orders", "o_orderstatus", "o_orderpriority"), predicates)


@query(
    "agg_extent",
    """SELECT min(l_extendedprice) AS min_l_extendedprice, max(l_extendedprice) AS max_l_extendedprice,
        min(l_quantity) AS min_l_quantity, max(l_quantity) AS max_l_quantity FROM lineitem""",
)
def agg_extent(spark, sf):
    return aggregates.extent(table(spark, sf, "lineitem"), ["l_extendedprice", "l_quantity"])


@query(
    "agg_equal_width_bins",
    """WITH c AS (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1), e AS (SELECT min(n) AS lo, max(n) AS hi FROM c)
       SELECT l_suppkey, n, CAST(CASE WHEN lo = hi THEN 1 ELSE least(floor(6.0 * (n - lo) / (hi - lo)) + 1, 6) END AS INTEGER) AS bin
       FROM c, e""",
)
def agg_equal_width_bins(spark, sf):
    counts = table(spark, sf, "lineitem", "l_suppkey").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    return aggregates.equal_width_bins(counts, {"n": "bin"}, 6)


@query(
    "agg_category_rank",
    """WITH u AS (SELECT 'o_orderpriority' AS category, o_orderpriority AS value FROM orders
        UNION ALL SELECT 'o_orderstatus', o_orderstatus FROM orders), c AS (SELECT category, value, count(*) AS len FROM u GROUP BY 1, 2)
       SELECT category, value, len, CAST(row_number() OVER (PARTITION BY category ORDER BY len DESC, value) AS INTEGER) AS rank FROM c""",
)
def agg_category_rank(spark, sf):
    orders = table(spark, sf, "orders", "o_orderpriority", "o_orderstatus").withColumn("all", F.lit(1))
    counts = aggregates.row_count_by_category(orders, "all", ["o_orderpriority", "o_orderstatus"]).drop("all")
    return aggregates.category_order(counts, "category", "value")


@query(
    "srt_multi_key",
    """SELECT c_custkey, c_nationkey, CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY
        list_position(['MACHINERY', 'HOUSEHOLD', 'FURNITURE', 'BUILDING', 'AUTOMOBILE'], c_mktsegment), c_custkey) AS INTEGER) AS place
       FROM customer""",
)
def srt_multi_key(spark, sf):
    """Declared order as a sort key, shown as each customer's place within its nation."""
    domain = ("MACHINERY", "HOUSEHOLD", "FURNITURE", "BUILDING", "AUTOMOBILE")
    customer = table(spark, sf, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    placed = rows.place_in_group(customer, ["c_nationkey"], [ordinal(F.col("c_mktsegment"), domain), F.col("c_custkey")])
    placed = placed.withColumn("place", F.col("place").cast("int"))
    ordered = rows.sort_coded(placed, ["c_nationkey", "c_mktsegment", "c_custkey"], {"c_mktsegment": domain})
    return ordered.select("c_custkey", "c_nationkey", "place")


@query(
    "lim_head_tail",
    """(SELECT 'head' AS part, o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 5)
       UNION ALL (SELECT 'tail', o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 5)""",
)
def lim_head_tail(spark, sf):
    orders = table(spark, sf, "orders", "o_orderkey", "o_orderdate")
    first = rows.head(orders, ["o_orderdate", "o_orderkey"]).select(F.lit("head").alias("part"), "*")
    last = rows.tail(orders, ["o_orderdate", "o_orderkey"]).select(F.lit("tail").alias("part"), "*")
    return first.unionByName(last)


@query("lim_sample", "SELECT c_custkey, c_name FROM customer ORDER BY md5('7|' || c_custkey), c_custkey LIMIT 20")
def lim_sample(spark, sf):
    return rows.sample_rows(table(spark, sf, "customer", "c_custkey", "c_name"), F.col("c_custkey"), 20, seed=7)


@query(
    "set_union_all",
    """SELECT s_name AS name, s_nationkey AS nation FROM supplier UNION ALL SELECT c_name, c_nationkey FROM customer
       UNION ALL SELECT c_name, c_nationkey FROM customer""",
)
def set_union_all(spark, sf):
    suppliers = table(spark, sf, "supplier").select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))
    customers = table(spark, sf, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_name").alias("name"))
    return rows.concat_same([suppliers, customers, customers])


@query(
    "set_union_wide",
    """SELECT s_name AS name, s_acctbal AS balance, NULL AS segment FROM supplier
       UNION ALL SELECT c_name, NULL, c_mktsegment FROM customer""",
)
def set_union_wide(spark, sf):
    suppliers = table(spark, sf, "supplier").select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    customers = table(spark, sf, "customer").select(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return rows.concat_wide([suppliers, customers])
