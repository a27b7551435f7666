"""Recoding: literal maps, lookup tables, code-books and domains."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarryline.functions import codes, nulls
from quarryline.operators import codebook, rows
from quarryline.plans.registry import query, table
from quarryline.session import scratch_path
from quarryline.sources.literal import literal_table

STATUS = {"F": "fulfilled", "O": "open", "P": "pending"}
_STATUS_SQL = "CASE o_orderstatus WHEN 'F' THEN 'fulfilled' WHEN 'O' THEN 'open' WHEN 'P' THEN 'pending' END"


@query("map_strict", f"SELECT o_orderkey, {_STATUS_SQL} AS status FROM orders")
def map_strict(spark, sf):
    orders = table(spark, sf, "orders", "o_orderkey", "o_orderstatus")
    return orders.select("o_orderkey", codes.recode_strict(F.col("o_orderstatus"), STATUS, "status").alias("status"))


@query(
    "map_lenient",
    "SELECT event_id, CASE event_type WHEN 'click' THEN 'c' WHEN 'view' THEN 'v' END AS kind FROM events",
)
def map_lenient(spark, sf):
    events = table(spark, sf, "events", "event_id", "event_type")
    return events.select("event_id", codes.recode_lenient(F.col("event_type"), {"click": "c", "view": "v"}).alias("kind"))


# Both engines derive the same code column; priority 5 stands for missing.
_CODE = "CASE WHEN o_orderpriority LIKE '5%' THEN '-1' ELSE substr(o_orderpriority, 1, 1) END"


@query(
    "map_codebook",
    f"""WITH book AS (SELECT DISTINCT {_CODE} AS code, o_orderpriority AS label FROM orders)
        SELECT o_orderkey, label AS priority FROM (SELECT o_orderkey, {_CODE} AS code FROM orders) o
        LEFT JOIN book ON o.code = book.code AND book.code <> '-1'""",
)
def map_codebook(spark, sf):
    """A code-book taken from the orders themselves, without its missing-value code."""
    orders = table(spark, sf, "orders", "o_orderkey", "o_orderpriority").select(
        "o_orderkey", "o_orderpriority", F.expr(_CODE).alias("priority")
    )
    book = orders.select(
        F.lit("orders").alias("table"), F.lit("priority").alias("field name"),
        F.col("priority").alias("code/format"), F.col("o_orderpriority").alias("label"),
    ).distinct()
    fields = codebook.CodeBook(codebook.read_codebook(book), drop_missing_code=True)
    return orders.select("o_orderkey", codes.recode_lenient(F.col("priority"), fields.literal("priority")).alias("priority"))


@query(
    "map_lookup_table",
    """SELECT c_custkey, n_name AS nation FROM customer LEFT JOIN
        (SELECT n_nationkey, n_name FROM nation WHERE n_regionkey <> 2) n ON c_nationkey = n_nationkey""",
)
def map_lookup_table(spark, sf):
    nation = table(spark, sf, "nation").filter("n_regionkey <> 2")
    lookup = codebook.lookup_from_columns(nation, 0, 1)
    joined = codebook.apply_lookup(table(spark, sf, "customer", "c_custkey", "c_nationkey"), "c_nationkey", lookup, "nation")
    return joined.select("c_custkey", "nation")


@query(
    "map_lookup_last_wins",
    """SELECT l_orderkey, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS label FROM (
        SELECT l_orderkey, l_suppkey FROM lineitem) l
       JOIN (SELECT CAST(o_custkey AS BIGINT) AS code, o_orderpriority, o_orderdate, o_orderkey FROM orders) o
        ON l.l_suppkey = o.code GROUP BY l_orderkey, l_suppkey""",
)
def map_lookup_last_wins(spark, sf):
    """A lookup with repeated codes: the last row in the given order is used."""
    orders = table(spark, sf, "orders", "o_custkey", "o_orderpriority", "o_orderdate", "o_orderkey")
    lookup = codebook.lookup_from_columns(orders, 0, 1, F.struct("o_orderdate", "o_orderkey"))
    lines = table(spark, sf, "lineitem", "l_orderkey", "l_suppkey").distinct()
    return codebook.apply_lookup(lines, "l_suppkey", lookup, "label").filter("label is not null").select("l_orderkey", "label")


@query(
    "map_override",
    """SELECT c_custkey, CASE c_nationkey WHEN 3 THEN 'three' WHEN 99 THEN 'none' ELSE n_name END AS nation
       FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
)
def map_override(spark, sf):
    base = codebook.lookup_from_columns(table(spark, sf, "nation"), 0, 1)
    lookup = codebook.override(base, codebook.literal_lookup(spark, {"3": "three", "99": "none"}))
    customer = table(spark, sf, "customer", "c_custkey", "c_nationkey")
    return codebook.apply_lookup(customer, "c_nationkey", lookup, "nation", strict=True).select("c_custkey", "nation")


@query(
    "map_fallback",
    """SELECT c_custkey, coalesce(n_name, 'Unknown') AS nation FROM customer LEFT JOIN
        (SELECT n_nationkey, n_name FROM nation WHERE n_regionkey <> 2) n ON c_nationkey = n_nationkey""",
)
def map_fallback(spark, sf):
    lookup = codebook.lookup_from_columns(table(spark, sf, "nation").filter("n_regionkey <> 2"), 0, 1)
    customer = table(spark, sf, "customer", "c_custkey", "c_nationkey")
    return codebook.apply_lookup(customer, "c_nationkey", lookup, "nation", fallback="Unknown").select("c_custkey", "nation")


@query(
    "map_null_key",
    """SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'Unknown' ELSE n_name END AS nation
       FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
)
def map_null_key(spark, sf):
    lookup = codebook.lookup_from_columns(table(spark, sf, "nation"), 0, 1)
    customer = table(spark, sf, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    holed = customer.withColumn("code", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_nationkey")))
    labelled = codebook.apply_lookup(holed, "code", lookup, "nation", strict=True, null_label="Unknown")
    return labelled.select("c_custkey", "nation")


@query(
    "map_union",
    """WITH levels AS (SELECT n_name AS code, 'nation' AS level FROM nation
        UNION ALL SELECT r_name, 'region' FROM region)
       SELECT c_custkey, place, level FROM (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN r_name ELSE n_name END AS place
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
       LEFT JOIN levels ON place = code""",
)
def map_union(spark, sf):
    """Codes of two levels in one column, mapped by the union of two lookups."""
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    lower = codebook.lookup_from_columns(nation.select("n_name", F.lit("nation").alias("level")))
    upper = codebook.lookup_from_columns(region.select("r_name", F.lit("region").alias("level")))
    customer = table(spark, sf, "customer", "c_custkey", "c_nationkey", "c_acctbal")
    placed = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    ).select("c_custkey", F.when(F.col("c_acctbal") < 0, F.col("r_name")).otherwise(F.col("n_name")).alias("place"))
    return codebook.apply_lookup(placed, "place", codebook.override(lower, upper), "level", strict=True)


_FOLDED = {"click": "visit", "view": "visit", "purchase": "sale", "signup": "sale", "error": "fault"}


@query(
    "map_many_to_one",
    """SELECT CASE WHEN event_type IN ('click', 'view') THEN 'visit' WHEN event_type IN ('purchase', 'signup') THEN 'sale'
        WHEN event_type = 'error' THEN 'fault' END AS kind, count(*) AS n FROM events GROUP BY 1""",
)
def map_many_to_one(spark, sf):
    events = table(spark, sf, "events", "event_type")
    kind = codes.recode_strict(F.col("event_type"), _FOLDED, "event_type")
    return events.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "map_sentinel_null",
    "SELECT p_partkey, CASE WHEN p_size IN (1, 50) THEN NULL ELSE p_size END AS p_size FROM part",
)
def map_sentinel_null(spark, sf):
    parts = table(spark, sf, "part", "p_partkey", "p_size")
    return parts.withColumn("p_size", nulls.sentinels_to_null(F.col("p_size"), [1, 50]))


@query(
    "map_domain_check",
    "SELECT c_custkey, c_nationkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS segment FROM customer",
)
def map_domain_check(spark, sf):
    """A literal domain and a lookup's domain; nulls pass both."""
    domain = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
    customer = table(spark, sf, "customer")
    holed = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))
    coded = customer.select(
        "c_custkey", F.col("c_nationkey").cast("string"), codes.in_domain_strict(holed, domain, "segment").alias("segment")
    )
    nations = codebook.lookup_from_columns(table(spark, sf, "nation"), 0, 1)
    checked = codebook.check_domain(coded, "c_nationkey", nations)
    return checked.withColumn("c_nationkey", F.col("c_nationkey").cast("int"))


@query(
    "map_domain_watch",
    """SELECT 'c_mktsegment' AS code_column, count(*) AS n_unknown, min(c_mktsegment) AS example FROM customer WHERE c_mktsegment IN ('HOUSEHOLD', 'MACHINERY')
       UNION ALL SELECT 'c_nationkey', count(*), min(CAST(c_nationkey AS VARCHAR)) FROM customer
        WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey <> 2)""",
)
def map_domain_watch(spark, sf):
    """Codes outside a literal domain and a lookup's, counted while a table without
    their labels is written."""
    segments = {s: s.lower() for s in ("AUTOMOBILE", "BUILDING", "FURNITURE")}
    nations = codebook.lookup_from_columns(table(spark, sf, "nation").filter("n_regionkey <> 2"), 0, 1)
    rules = [
        (codebook.Recode("c_mktsegment", "segment", strict=True), segments),
        (codebook.Recode("c_nationkey", "nation", strict=True), nations),
    ]
    watch = codebook.DomainWatch()
    watched, _ = codebook.watched_labels(table(spark, sf, "customer"), rules, watch)
    watched.select("c_custkey", "c_mktsegment", "c_nationkey").write.parquet(scratch_path(spark, "watched"))
    return literal_table(spark, watch.counts(), "code_column string, n_unknown bigint, example string")


@query("map_observed_domain", "SELECT DISTINCT p_type FROM part WHERE p_type IS NOT NULL")
def map_observed_domain(spark, sf):
    return codebook.observed_domain(table(spark, sf, "part"), "p_type")


@query(
    "map_enum_order",
    f"""SELECT o_orderkey, {_STATUS_SQL} AS status,
        CAST(CASE o_orderstatus WHEN 'P' THEN 1 WHEN 'O' THEN 2 WHEN 'F' THEN 3 END AS INTEGER) AS status_order FROM orders""",
)
def map_enum_order(spark, sf):
    """Labels compare in declaration order (pending, open, fulfilled), not by letter."""
    domain = ("pending", "open", "fulfilled")
    orders = table(spark, sf, "orders", "o_orderkey", "o_orderstatus")
    labelled = orders.select("o_orderkey", codes.recode_strict(F.col("o_orderstatus"), STATUS).alias("status"))
    sorted_rows = rows.sort_coded(labelled, ["status", "o_orderkey"], {"status": domain})
    return sorted_rows.withColumn("status_order", codes.ordinal(F.col("status"), domain))


@query(
    "map_unmapped_codes",
    """SELECT DISTINCT CAST(c_nationkey AS VARCHAR) AS code FROM customer
       WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey <> 2)""",
)
def map_unmapped_codes(spark, sf):
    lookup = codebook.lookup_from_columns(table(spark, sf, "nation").filter("n_regionkey <> 2"), 0, 1)
    return codebook.unmapped_codes(table(spark, sf, "customer"), "c_nationkey", lookup)
