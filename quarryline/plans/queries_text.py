"""String, hash and arithmetic functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarryline.functions import maths, text
from quarryline.operators.aggregates import distinct_list
from quarryline.operators.quality import digest_state
from quarryline.plans.registry import query, table

_PADDED = "CASE WHEN c_acctbal < 0 THEN '  ' || c_name || ' ' ELSE chr(9) || c_name || '  ' END"


@query("str_trim", f"SELECT c_custkey, trim({_PADDED}, ' ') AS name FROM customer")
def str_trim(spark, sf):
    customer = table(spark, sf, "customer", "c_custkey", "c_acctbal", "c_name")
    return customer.select("c_custkey", text.trim_spaces(F.expr(_PADDED)).alias("name"))


@query("str_lower", "SELECT p_partkey, lower(p_name) AS name, upper(p_type) AS kind FROM part")
def str_lower(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.lower("p_name").alias("name"), F.upper("p_type").alias("kind"))


@query(
    "str_replace_first",
    """SELECT doc_id, CASE WHEN instr(text, 'on') > 0 THEN substr(text, 1, instr(text, 'on') - 1) || 'ON!'
        || substr(text, instr(text, 'on') + 2) ELSE text END AS text FROM documents""",
)
def str_replace_first(spark, sf):
    documents = table(spark, sf, "documents", "doc_id", "text")
    return documents.select("doc_id", text.replace_first(F.col("text"), "on", "ON!").alias("text"))


@query("str_split_head", "SELECT o_orderkey, split_part(o_orderpriority, '-', 1) AS head FROM orders")
def str_split_head(spark, sf):
    orders = table(spark, sf, "orders", "o_orderkey", "o_orderpriority")
    return orders.select("o_orderkey", text.split_head(F.col("o_orderpriority"), "-").alias("head"))


@query(
    "str_zero_pad",
    """SELECT o_orderkey, CASE WHEN length(CAST(o_custkey AS VARCHAR)) < 3
        THEN lpad(CAST(o_custkey AS VARCHAR), 3, '0') ELSE CAST(o_custkey AS VARCHAR) END AS code FROM orders""",
)
def str_zero_pad(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", text.zero_pad(F.col("o_custkey"), 3).alias("code"))


@query(
    "str_distinct_list",
    """SELECT user_id, array_to_string(list_sort(list_distinct(list(upper(event_type)))), ',') AS kinds
       FROM events GROUP BY user_id""",
)
def str_distinct_list(spark, sf):
    events = table(spark, sf, "events", "user_id", "event_type")
    return events.groupBy("user_id").agg(distinct_list(F.upper("event_type")).alias("kinds"))


@query(
    "hash_md5",
    """SELECT d.doc_id, md5(text) AS digest, CASE WHEN l.doc_id IS NULL THEN 'unverified' WHEN l.toxic = 0 THEN 'ok'
        ELSE 'mismatch' END AS state FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def hash_md5(spark, sf):
    """Whole texts against an expected digest: right, wrong or not known."""
    documents, labels = table(spark, sf, "documents", "doc_id", "text"), table(spark, sf, "labels", "doc_id", "toxic")
    expected = F.when(F.col("toxic") == 0, F.md5(F.col("text").cast("binary"))).when(F.col("toxic") == 1, F.lit("0"))
    joined = documents.join(labels, "doc_id", "left").withColumn("expected", expected)
    return digest_state(joined, "text", "expected").select("doc_id", "digest", "state")


@query(
    "mth_power",
    "SELECT p_partkey, CAST(pow(p_size, 3) AS INTEGER) AS cube, CAST(pow(p_size, 2) AS INTEGER) AS square FROM part",
)
def mth_power(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", F.pow("p_size", F.lit(3)).cast("int").alias("cube"), F.pow("p_size", F.lit(2)).cast("int").alias("square")
    )


_AMOUNT = "CASE WHEN c_mktsegment = 'BUILDING' THEN 0.0 ELSE abs(c_acctbal) END"


@query(
    "mth_log",
    f"SELECT c_custkey, CASE WHEN v = 0 THEN '-Infinity' ELSE CAST(CAST(round(ln(v) * 1e9) AS BIGINT) AS VARCHAR) END AS v FROM (SELECT c_custkey, {_AMOUNT} AS v FROM customer)",
)
def mth_log(spark, sf):
    """Nine decimals as text, so that minus infinity can be compared."""
    customer = table(spark, sf, "customer", "c_custkey", "c_mktsegment", "c_acctbal")
    log = maths.ln_ieee(F.expr(_AMOUNT).cast("double"))
    shown = F.when(log == float("-inf"), F.lit("-Infinity")).otherwise(F.round(log * 1e9).cast("bigint").cast("string"))
    return customer.select("c_custkey", shown.alias("v"))


@query(
    "mth_sensor_mean",
    """SELECT user_id, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS DOUBLE) / (count(*) * 1000.0) AS mean
       FROM events GROUP BY user_id""",
)
def mth_sensor_mean(spark, sf):
    """Integer milli-units summed exactly, then scaled once."""
    events = table(spark, sf, "events", "user_id", "props")
    milli = F.get_json_object("props", "$.k").cast("bigint")
    return events.groupBy("user_id").agg(maths.mean_of_milli(milli).alias("mean"))
