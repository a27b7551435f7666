"""Queries over readers: written to the shared folder first, then read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarryline.functions.text import harvest_any, header_names
from quarryline.operators.codebook import read_codebook
from quarryline.operators.spatial import ring_edges, rings
from quarryline.plans.registry import query, table
from quarryline.session import scratch_path
from quarryline.sources import files, literal, text

# A quoted empty field, a missing field and plain text in one column.
_REMARK = """CASE WHEN c_mktsegment = 'BUILDING' THEN '' WHEN c_mktsegment = 'MACHINERY' THEN NULL
    ELSE c_mktsegment || ', "' || c_name || '"' END"""


@query(
    "src_csv_strings",
    f"""SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CAST(c_acctbal AS VARCHAR) AS c_acctbal,
        {_REMARK} AS remark FROM customer""",
)
def src_csv_strings(spark, sf):
    path = scratch_path(spark, "customer-csv")
    customer = table(spark, sf, "customer").select("c_custkey", "c_acctbal", F.expr(_REMARK).alias("remark"))
    customer.write.options(header=True, escape='"').csv(path)
    return text.read_csv(spark, path, ["c_custkey", "c_acctbal", "remark"])


@query(
    "src_csv_typed",
    """SELECT o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderstatus FROM orders""",
)
def src_csv_typed(spark, sf):
    path = scratch_path(spark, "orders-csv")
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", F.col("o_orderdate").cast("date"), "o_orderstatus"
    )
    orders.write.option("header", True).csv(path)
    types = {"o_orderkey": "bigint", "o_totalprice": "double", "o_orderdate": "date", "o_orderstatus": "string"}
    return text.read_csv_typed(spark, path, types)


@query(
    "src_csv_headerless",
    """SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS buyer, o_orderpriority AS priority
       FROM orders""",
)
def src_csv_headerless(spark, sf):
    path = scratch_path(spark, "orders-headerless")
    table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderpriority").write.csv(path)
    return text.read_csv(spark, path, ["id", "buyer", "priority"], header=False)


@query("src_csv_glob", "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_type FROM part")
def src_csv_glob(spark, sf):
    path = scratch_path(spark, "part-glob")
    parts = table(spark, sf, "part", "p_partkey", "p_name", "p_type", "p_brand")
    parts.write.partitionBy("p_brand").csv(path)
    return text.read_csv(spark, f"{path}/*/*.csv", ["p_partkey", "p_name", "p_type"], header=False)


@query(
    "src_sidecar_header",
    """SELECT CAST(s_suppkey AS VARCHAR) AS "Supplier", s_name AS "Name", CAST(s_acctbal AS VARCHAR) AS "Balance"
       FROM supplier""",
)
def src_sidecar_header(spark, sf):
    path = scratch_path(spark, "supplier-sidecar")
    table(spark, sf, "supplier", "s_suppkey", "s_name", "s_acctbal").write.csv(f"{path}/data")
    names = literal.literal_table(spark, [("SU,NA,BA",), ("Supplier,Name,Balance",)], "value string")
    names.coalesce(1).write.text(f"{path}/doc")
    return text.read_csv_sidecar(spark, f"{path}/data", f"{path}/doc")


@query(
    "src_parquet",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000",
)
def src_parquet(spark, sf):
    orders = files.read_parquet(spark, f"{sf}/orders.parquet")
    return orders.filter("o_orderstatus = 'F' AND o_totalprice > 100000").select("o_orderkey", "o_totalprice")


@query(
    "src_parquet_partitioned",
    """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period, count(*) AS n,
        CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
       FROM orders WHERE o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '1999-01-01' GROUP BY 1""",
)
def src_parquet_partitioned(spark, sf):
    path = scratch_path(spark, "orders-by-month")
    orders = table(spark, sf, "orders", "o_orderdate", "o_totalprice")
    monthly = orders.withColumn("period", F.trunc("o_orderdate", "month"))
    monthly.hint("rebalance", "period").write.partitionBy("period").parquet(path)
    kept = files.read_parquet(spark, path).filter("period >= DATE '1997-01-01' AND period < DATE '1999-01-01'")
    return kept.groupBy("period").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"),
    )


@query(
    "src_inline",
    """SELECT coalesce(m.meaning, 'other') AS meaning, count(*) AS n FROM events e
       LEFT JOIN (VALUES ('click', '1'), ('purchase', '2.5'), ('signup', 'x')) m(kind, meaning)
       ON e.event_type = m.kind GROUP BY 1""",
)
def src_inline(spark, sf):
    meanings = literal.inline(spark, {"kind": ["click", "purchase", "signup"], "meaning": [1, 2.5, "x"]})
    events = table(spark, sf, "events", "event_type")
    named = events.join(meanings, F.col("event_type") == F.col("kind"), "left")
    return named.groupBy(F.coalesce("meaning", F.lit("other")).alias("meaning")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "src_codebook",
    """SELECT DISTINCT 'collision' AS "table", 'enhanced_severity_collision' AS field,
        split_part(o_orderpriority, '-', 1) AS code, split_part(o_orderpriority, '-', 2) AS label FROM orders""",
)
def src_codebook(spark, sf):
    path = scratch_path(spark, "codebook")
    names = ["table", "field name", "code/format", "label"]
    priority = F.col("o_orderpriority")
    book = table(spark, sf, "orders", "o_orderpriority").distinct().select(
        F.lit("accident").alias(names[0]),
        F.lit("enhanced_collision_severity").alias(names[1]),
        F.split_part(priority, F.lit("-"), F.lit(1)).alias(names[2]),
        F.split_part(priority, F.lit("-"), F.lit(2)).alias(names[3]),
    )
    book.write.option("header", True).csv(path)
    return read_codebook(text.read_csv(spark, path, names))


_CORNERS = ((0, 0), (4, 0), (4, 3), (0, 3), (0, 0))


@query(
    "src_geojson",
    """SELECT s_suppkey AS supplier, s_name AS name, CAST(0 AS INTEGER) AS part, CAST(0 AS INTEGER) AS ring, e.seq,
        CAST(s_suppkey + e.ax AS DOUBLE) AS x1, CAST(e.ay AS DOUBLE) AS y1,
        CAST(s_suppkey + e.bx AS DOUBLE) AS x2, CAST(e.by_ AS DOUBLE) AS y2
       FROM supplier, (VALUES (0, 0, 0, 4, 0), (1, 4, 0, 4, 3), (2, 4, 3, 0, 3), (3, 0, 3, 0, 0))
        e(seq, ax, ay, bx, by_)""",
)
def src_geojson(spark, sf):
    """Supplier rectangles written as chunked FeatureCollections, alternately as
    polygons and multi-polygons, then read back as edges."""
    path = scratch_path(spark, "geojson")
    supplier = table(spark, sf, "supplier", "s_suppkey", "s_name", "s_nationkey")
    x = F.col("s_suppkey").cast("double")
    ring = F.array(*[F.array(x + dx, F.lit(float(dy))) for dx, dy in _CORNERS])
    even = F.col("s_nationkey") % 2 == 0
    geometry = F.when(
        even, F.concat(F.lit('{"type":"Polygon","coordinates":'), F.to_json(F.array(ring)), F.lit("}"))
    ).otherwise(
        F.concat(F.lit('{"type":"MultiPolygon","coordinates":'), F.to_json(F.array(F.array(ring))), F.lit("}"))
    )
    properties = F.to_json(F.struct(F.col("s_suppkey").alias("supplier"), F.col("s_name").alias("name")))
    feature = F.concat(
        F.lit('{"type":"Feature","id":'), F.col("s_suppkey").cast("string"),
        F.lit(',"geometry":'), geometry, F.lit(',"properties":'), properties, F.lit("}"),
    )
    chunked = supplier.select(F.floor(F.col("s_suppkey") / 200).alias("chunk"), feature.alias("feature"))
    documents = chunked.groupBy("chunk").agg(
        F.concat(
            F.lit('{"type":"FeatureCollection","features":['),
            F.array_join(F.collect_list("feature"), ","),
            F.lit("]}"),
        ).alias("value")
    )
    documents.write.partitionBy("chunk").text(path)
    features = files.read_geojson(spark, f"{path}/*/*.txt", "supplier bigint, name string")
    return ring_edges(rings(features, ["supplier", "name"]), ["supplier", "name"])


@query(
    "src_json_array",
    """SELECT event_id, event_type AS name, 'k' AS type, CAST(json_extract(props, '$.k') AS VARCHAR) AS url FROM events
       UNION ALL SELECT event_id, 'user', 'id', CAST(user_id AS VARCHAR) FROM events""",
)
def src_json_array(spark, sf):
    events = table(spark, sf, "events", "event_id", "user_id", "event_type", "props")
    rows = F.array(
        F.struct(
            F.col("event_type").alias("name"), F.lit("k").alias("type"),
            F.get_json_object("props", "$.k").alias("url"),
        ),
        F.struct(F.lit("user").alias("name"), F.lit("id").alias("type"), F.col("user_id").cast("string").alias("url")),
    )
    payload = events.select("event_id", F.to_json(F.struct(rows.alias("services"))).alias("body"))
    return files.payload_rows(payload, "body", "services", files.SERVICE_ROW, ["event_id"])


_MEMBER = """CASE o_orderstatus WHEN 'F' THEN '-north-street.csv' WHEN 'O' THEN '-north-outcomes.csv'
    ELSE '-south-street.csv.old' END"""


@query(
    "src_member_filter",
    f"""SELECT o_orderkey, name FROM (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') || {_MEMBER} AS name FROM orders)
        WHERE name LIKE '1998-05%' AND split_part(name, '.csv', 1) LIKE '%-street'""",
)
def src_member_filter(spark, sf):
    orders = table(spark, sf, "orders", "o_orderkey", "o_orderdate", "o_orderstatus")
    name = F.concat(F.date_format("o_orderdate", "yyyy-MM"), F.expr(_MEMBER))
    members = orders.select("o_orderkey", name.alias("name"))
    return members.filter(files.is_member(F.col("name"), F.lit("1998-05-01").cast("date")))


@query(
    "src_listing_key",
    r"""SELECT page_id, name, stem, split_part(stem, '-', 1) AS key FROM (
        SELECT page_id, name, regexp_replace(name, '\.[^.]*$', '') AS stem FROM (
            SELECT page_id, list_extract(string_split(url, '/'), -1) AS name FROM pages)) WHERE stem <> '1'""",
)
def src_listing_key(spark, sf):
    pages = table(spark, sf, "pages", "page_id", "url").withColumnRenamed("url", "path")
    return files.keyed(files.named(pages), exclude=["1"]).select("page_id", "name", "stem", "key")


@query(
    "src_latest",
    """SELECT user_id, arg_max(path, (modified, path)) AS path, max(modified) AS modified FROM (
        SELECT user_id, event_type || '/' || event_id AS path, ts AS modified FROM events) GROUP BY user_id""",
)
def src_latest(spark, sf):
    events = table(spark, sf, "events", "user_id", "event_type", "event_id", "ts")
    path = F.concat("event_type", F.lit("/"), F.col("event_id").cast("string"))
    return files.latest(events.select("user_id", path.alias("path"), F.col("ts").alias("modified")), keys=["user_id"])


@query(
    "src_html_attrs",
    r"""SELECT page_id, array_to_string(list_sort(list_distinct(list_transform(
            list_filter(regexp_extract_all(html, '(?i)<a\b([^>]*)>', 1),
                lambda t: regexp_matches(' ' || t, '(?i)\shref\s*=\s*["'']([^"'']*)["'']')),
            lambda t: upper(replace(regexp_extract(' ' || t, '(?i)\shref\s*=\s*["'']([^"'']*)["'']', 1), 'ß', 'ss'))))), ',') AS links
        FROM pages""",
)
def src_html_attrs(spark, sf):
    return table(spark, sf, "pages", "page_id", "html").select(
        "page_id", harvest_any(F.col("html"), "a", "href").alias("links")
    )


@query(
    "prj_header_style",
    """SELECT c_custkey AS "C Custkey", c_name AS "C Name", c_nationkey AS "C Nationkey" FROM customer""",
)
def prj_header_style(spark, sf):
    customer = table(spark, sf, "customer", "c_custkey", "c_name", "c_nationkey")
    return customer.withColumnsRenamed(header_names(customer.columns, "title"))
