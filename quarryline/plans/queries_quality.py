"""Checks over manifests, payloads, chunks and locations."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarryline.datasets import road_collisions
from quarryline.functions.nulls import pair_mismatch
from quarryline.operators import calendars, quality
from quarryline.plans.registry import query, table


@query(
    "dq_status",
    """SELECT event_id, url, status, 'bad response for ' || event_id || ' at ' || url || ': ' || status AS message FROM (
        SELECT event_id, 'http://example.org/' || user_id AS url,
            CAST(CASE event_type WHEN 'error' THEN 500 WHEN 'signup' THEN 404 ELSE 200 END AS INTEGER) AS status FROM events)
       WHERE status <> 200""",
)
def dq_status(spark, sf):
    events = table(spark, sf, "events", "event_id", "user_id", "event_type")
    status = F.when(F.col("event_type") == "error", 500).when(F.col("event_type") == "signup", 404).otherwise(200)
    manifest = events.select(
        "event_id", F.concat(F.lit("http://example.org/"), F.col("user_id").cast("string")).alias("url"), status.alias("status")
    )
    return quality.bad_status(manifest, "status", "event_id", "url")


_BODY = """CASE event_type WHEN 'error' THEN '{"error": {"code": 400}}'
    WHEN 'signup' THEN '{"properties": {"exceededTransferLimit": true}, "features": []}'
    WHEN 'view' THEN '{"properties": {"exceededTransferLimit": false}, "features": []}' ELSE props END"""


@query(
    "dq_payload_flags",
    """SELECT event_id, event_type = 'signup' AS truncated, event_type = 'error' AS failed FROM events
       WHERE event_type IN ('signup', 'error')""",
)
def dq_payload_flags(spark, sf):
    events = table(spark, sf, "events", "event_id", "event_type", "props")
    return quality.payload_problems(events.withColumn("body", F.expr(_BODY)), "body", ["event_id"])


_START = "CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderkey END"
_END = "CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_custkey END"


@query(
    "dq_pair_null",
    f"SELECT o_orderkey FROM (SELECT o_orderkey, {_START} AS s, {_END} AS e FROM orders) WHERE (s IS NULL) <> (e IS NULL)",
)
def dq_pair_null(spark, sf):
    orders = table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    pairs = orders.select("o_orderkey", F.expr(_START).alias("s"), F.expr(_END).alias("e"))
    return pairs.filter(pair_mismatch(F.col("s"), F.col("e"))).select("o_orderkey")


@query(
    "dq_chunk_gaps",
    """WITH c AS (SELECT count(*) AS n FROM events),
        m AS (SELECT unnest(range(0, CAST(ceil(n / 40.0) AS BIGINT))) AS chunk, n FROM c),
        g AS (SELECT (event_id // 40) AS chunk, count(DISTINCT event_id) AS landed FROM events WHERE event_type <> 'error' GROUP BY 1),
        j AS (SELECT m.chunk, chunk * 40 + 1 AS id_start, least((chunk + 1) * 40, n) AS id_end, coalesce(landed, 0) AS n_landed
              FROM m LEFT JOIN g USING (chunk))
       SELECT chunk, n_landed, id_end - id_start + 1 AS n_declared FROM j WHERE n_landed <> id_end - id_start + 1""",
)
def dq_chunk_gaps(spark, sf):
    """Declared: every event.  Landed: all but the errors."""
    events = table(spark, sf, "events", "event_id", "event_type")
    counts = events.agg(F.count(F.lit(1)).alias("n"))
    manifest = calendars.chunks(counts, F.col("n"), 40)
    landed = events.filter("event_type <> 'error'").select((F.col("event_id") + 1).alias("id"))
    return quality.chunk_gaps(manifest, landed, "id", 40).select("chunk", "n_landed", "n_declared")


@query(
    "dq_chunk_strays",
    """WITH ids AS (SELECT DISTINCT CASE event_type WHEN 'signup' THEN event_id + 1000003 ELSE event_id + 1 END AS id
                   FROM events WHERE event_type <> 'error'),
        m AS (SELECT unnest(range(0, (SELECT CAST(ceil(count(*) / 40.0) AS BIGINT) FROM events))) AS c),
        d AS (SELECT c, c * 40 + 1 AS lo, least((c + 1) * 40, (SELECT count(*) FROM events)) AS hi FROM m),
        j AS (SELECT CAST((id - 1) // 40 AS BIGINT) AS c, id FROM ids),
        t AS (SELECT coalesce(d.c, j.c) AS chunk, count(*) FILTER (id BETWEEN lo AND hi) AS n_landed,
                count(*) FILTER (id IS NOT NULL AND (lo IS NULL OR id < lo OR id > hi)) AS n_stray,
                coalesce(max(hi - lo + 1), 0) AS n_declared FROM d FULL JOIN j ON d.c = j.c GROUP BY 1)
       SELECT * FROM t WHERE n_landed <> n_declared OR n_stray > 0""",
)
def dq_chunk_strays(spark, sf):
    """Sign-ups land under ids nobody declared, errors don't land."""
    events = table(spark, sf, "events", "event_id", "event_type")
    manifest = calendars.chunks(events.agg(F.count(F.lit(1)).alias("n")), F.col("n"), 40)
    id_ = F.col("event_id") + F.when(F.col("event_type") == "signup", 1000003).otherwise(1)
    landed = events.filter("event_type <> 'error'").select(id_.alias("id"))
    return quality.chunk_gaps(manifest, landed, "id", 40).select("chunk", "n_landed", "n_stray", "n_declared")


@query(
    "dq_status_null",
    """SELECT event_id, 'bad response for ' || event_id || ' at x: ' || CASE event_type WHEN 'error' THEN 'null' ELSE '404' END AS message
       FROM events WHERE event_type IN ('error', 'signup')""",
)
def dq_status_null(spark, sf):
    """A response that never came has no status."""
    events = table(spark, sf, "events", "event_id", "event_type")
    status = F.when(F.col("event_type") == "signup", 404).when(F.col("event_type") != "error", 200)
    manifest = events.select("event_id", F.lit("x").alias("url"), status.alias("status"))
    return quality.bad_status(manifest, "status", "event_id", "url").select("event_id", "message")


_COLLISIONS = """SELECT CAST(o_orderkey AS VARCHAR(20)) AS accident_index, year(o_orderdate) AS accident_year,
    CASE o_orderstatus WHEN 'F' THEN 'Fatal' WHEN 'O' THEN 'Serious' ELSE 'Slight' END AS accident_severity,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN NULL ELSE 51.5 END AS latitude,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN NULL ELSE -0.1 END AS longitude,
    CASE WHEN o_totalprice < 250000 THEN NULL ELSE 'E09' END AS local_authority_ons_district,
    CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE 'Barnet' END AS local_authority_district FROM orders"""
_LOST = "latitude IS NULL AND longitude IS NULL AND local_authority_ons_district IS NULL"


def _collisions(spark, sf):
    return spark.sql(_COLLISIONS.replace("FROM orders", "FROM {orders}"), orders=table(spark, sf, "orders"))


@query(
    "dq_missing_location",
    f"""SELECT CAST(accident_year AS BIGINT) AS accident_year_int, CAST(accident_year AS VARCHAR) AS accident_year, accident_severity,
        count(*) AS count FROM ({_COLLISIONS}) WHERE {_LOST} GROUP BY 1, 2, 3""",
)
def dq_missing_location(spark, sf):
    found = road_collisions.unlocated_by_year(_collisions(spark, sf))
    return found.withColumn("accident_year_int", F.col("accident_year_int").cast("bigint"))


@query(
    "dq_location_shares",
    f"""SELECT count(*) AS n_total, count(*) FILTER ({_LOST}) AS n_no_coordinates,
        CAST(count(*) FILTER ({_LOST}) AS DOUBLE) / count(*) AS share_no_coordinates,
        count(*) FILTER ({_LOST} AND local_authority_district IS NULL) AS n_no_location,
        CAST(count(*) FILTER ({_LOST} AND local_authority_district IS NULL) AS DOUBLE) / count(*) AS share_no_location
       FROM ({_COLLISIONS})""",
)
def dq_location_shares(spark, sf):
    return road_collisions.location_shares(_collisions(spark, sf))


@query(
    "dq_exactly_one",
    """SELECT o_orderkey, CAST(o_custkey AS VARCHAR) || '.csv' AS member FROM orders""",
)
def dq_exactly_one(spark, sf):
    """One matching member per order among a matching and a non-matching one."""
    orders = table(spark, sf, "orders", "o_orderkey", "o_custkey")
    name = F.col("o_custkey").cast("string")
    members = orders.select(
        "o_orderkey", F.explode(F.array(F.concat(name, F.lit(".csv")), F.concat(name, F.lit(".txt")))).alias("member")
    )
    return quality.exactly_one(members, ["o_orderkey"], "member", F.col("member").endswith(".csv"))


@query(
    "dq_no_match",
    """SELECT o_orderkey, CAST(0 AS BIGINT) AS n_matches FROM orders WHERE o_orderstatus = 'F'""",
)
def dq_no_match(spark, sf):
    """Orders whose members are all of another kind: a key without a match is reported."""
    orders = table(spark, sf, "orders", "o_orderkey", "o_orderstatus")
    kinds = F.array(F.lit("a.txt"), F.when(F.col("o_orderstatus") == "F", "b.txt").otherwise("b.csv"))
    members = orders.select("o_orderkey", F.explode(kinds).alias("member"))
    return quality.match_counts(members, ["o_orderkey"], "member", F.col("member").endswith(".csv"))


@query(
    "dq_match_counts",
    """SELECT l_orderkey, count(CASE WHEN l_returnflag = 'R' THEN l_shipdate END) AS n_matches FROM lineitem GROUP BY 1
       HAVING count(CASE WHEN l_returnflag = 'R' THEN l_shipdate END) <> 1""",
)
def dq_match_counts(spark, sf):
    lines = table(spark, sf, "lineitem", "l_orderkey", "l_returnflag", "l_shipdate")
    flagged = lines.select("l_orderkey", F.when(F.col("l_returnflag") == "R", F.col("l_shipdate")).alias("hit"))
    return quality.match_counts(flagged, ["l_orderkey"], "hit")
