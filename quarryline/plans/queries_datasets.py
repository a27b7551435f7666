"""Whole data-set runs: raw text in the published shape is derived from the given
tables, then cleaned, coded and analysed by the data-set modules."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from quarryline.datasets import postcodes, price_paid, road_collisions, schools, street_crime
from quarryline.operators import calendars
from quarryline.operators.codebook import CodeBook, read_codebook
from quarryline.plans.queries_spatial import EAST, NORTH, grid_sql
from quarryline.plans.registry import query, table
from quarryline.session import scratch_path
from quarryline.sources.literal import literal_table
from quarryline.sources.text import read_csv

_DOWNLOADED = datetime(2024, 11, 1)
_STAMP = "TIMESTAMP '2024-11-01 00:00:00' AS datetime_download"


def _pick(values, key: str, quote: str = "'") -> str:
    """CASE over a list of fixed values, chosen by a number; the same text in both engines."""
    cases = " ".join(f"WHEN {i} THEN {quote}{v}{quote}" for i, v in enumerate(values))
    return f"(CASE {key} % {len(values)} {cases} END)"


# ---- price paid ------------------------------------------------------------

_CODE_KEYS = dict(zip(price_paid.CODES, ("o_orderkey", "c_custkey", "o_custkey", "o_orderkey", "c_nationkey"), strict=True))


def _sale(name: str) -> str:
    special = {
        "id_transaction": "CAST(o_orderkey AS VARCHAR(20))",
        "price": "CAST(o_totalprice AS VARCHAR(30))",
        "postcode": "' ' || c_mktsegment || ' ' || CAST(c_nationkey AS VARCHAR(9)) || ' '",
        "street": "CASE WHEN c_acctbal < 0 THEN NULL ELSE c_name END",
        "county": "CASE WHEN c_nationkey < 5 THEN 'GREATER LONDON' ELSE 'KENT' END",
    }
    if name in special:
        return special[name]
    if name in price_paid.CODES:
        return _pick(price_paid.CODES[name], _CODE_KEYS[name])
    return f"'{name[:4]}'"


def _sales_sql(date: str, transform=lambda name, raw: raw) -> str:
    columns = ", ".join(
        f"{date} AS date" if c == "date" else f"{transform(c, _sale(c))} AS {c}" for c in price_paid.COLUMNS
    )
    return f"SELECT {columns} FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey"


def _cleaned_sql() -> str:
    def cleaned(name: str, raw: str) -> str:
        if name == "price":
            return f"CAST({raw} AS DOUBLE)"
        if name == "postcode":
            return f"trim({raw}, ' ')"
        if name in price_paid.CODES:
            return _pick(price_paid.DOMAINS[name], _CODE_KEYS[name])
        return raw

    return _sales_sql("CAST(o_orderdate AS DATE)", cleaned).format(orders="orders", customer="customer")


_CLEANED_SALES = _cleaned_sql()


def _sales(spark, sf):
    """Written and read back as the headerless files they are published as."""
    raw = spark.sql(
        _sales_sql("date_format(o_orderdate, 'yyyy-MM-dd HH:mm')"),
        orders=table(spark, sf, "orders"),
        customer=table(spark, sf, "customer"),
    )
    path = scratch_path(spark, "sales")
    raw.write.options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return price_paid.clean(price_paid.read_raw(spark, path), _DOWNLOADED)


@query("etl_price_paid", f"SELECT *, {_STAMP} FROM ({_CLEANED_SALES})")
def etl_price_paid(spark, sf):
    return _sales(spark, sf)


_PLACES = """SELECT DISTINCT c_mktsegment || ' ' || CAST(c_nationkey AS VARCHAR(9)) AS postcode,
    CASE WHEN c_nationkey = 7 THEN NULL ELSE c_nationkey * 0.5 END AS longitude,
    50 + c_nationkey * 0.25 AS latitude FROM {customer} WHERE c_nationkey < 20"""


def _placed(spark, sf):
    places = spark.sql(_PLACES, customer=table(spark, sf, "customer"))
    exact = places.withColumns({c: F.col(c).cast("double") for c in ("longitude", "latitude")})
    return _sales(spark, sf), exact


@query(
    "etl_unplaced_postcodes",
    f"""SELECT DISTINCT postcode FROM ({_CLEANED_SALES}) LEFT JOIN ({_PLACES.format(customer='customer')}) USING (postcode)
        WHERE longitude IS NULL""",
)
def etl_unplaced_postcodes(spark, sf):
    return price_paid.unplaced_postcodes(*_placed(spark, sf))


@query(
    "etl_sales_per_category",
    " UNION ALL ".join(
        f"SELECT CAST(date_trunc('year', date) AS DATE) AS year, '{c}' AS category, {c} AS value, count(*) AS len FROM ({_CLEANED_SALES}) GROUP BY 1, 3"
        for c in price_paid.CODES
    ),
)
def etl_sales_per_category(spark, sf):
    return price_paid.sales_per_category(price_paid.with_periods_and_place(*_placed(spark, sf)))


@query(
    "etl_price_quantiles",
    """SELECT CAST(date_trunc('month', date) AS DATE) AS month, property_type, """
    + ", ".join(
        f"list_extract(list_sort(list(price)), CAST(floor((count(*) - 1) * CAST({q} AS DOUBLE) + 0.5) AS INTEGER) + 1) AS \"price_q{q:.2f}\""
        for q in (0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95)
    )
    + f" FROM ({_CLEANED_SALES}) GROUP BY 1, 2",
)
def etl_price_quantiles(spark, sf):
    return price_paid.price_quantiles(price_paid.with_periods_and_place(*_placed(spark, sf)), ["month", "property_type"])


@query(
    "etl_log_median_by_place",
    f"""SELECT CAST(date_trunc('year', date) AS DATE) AS year, CAST(longitude AS DOUBLE) AS longitude, CAST(latitude AS DOUBLE) AS latitude,
        round(ln(median(price)), 9) AS price FROM ({_CLEANED_SALES}) LEFT JOIN ({_PLACES.format(customer='customer')}) USING (postcode)
        WHERE county = 'GREATER LONDON' AND transaction_type = 'standard_price_paid_entry' GROUP BY 1, 2, 3""",
)
def etl_log_median_by_place(spark, sf):
    placed = price_paid.with_periods_and_place(*_placed(spark, sf))
    found = price_paid.log_median_by_place(placed, "GREATER LONDON")
    return found.withColumn("price", F.round("price", 9))


# ---- street crime ----------------------------------------------------------

_QUOTED_FORCES = [f.replace("'", "''") for f in street_crime.FORCES]
_CRIMES = f"""SELECT CAST(event_id AS VARCHAR(20)) AS `Crime ID`, {{month}} AS `Month`, {_pick(_QUOTED_FORCES, 'user_id')} AS `Reported by`,
    {_pick(_QUOTED_FORCES, 'event_id')} AS `Falls within`, CAST(value / 8 AS VARCHAR(30)) AS `Longitude`,
    CASE WHEN event_type = 'error' THEN NULL ELSE '51.5' END AS `Latitude`, 'On or near ' || event_type AS `Location`,
    'E0' || CAST(user_id AS VARCHAR(9)) AS `LSOA code`, CASE WHEN event_type = 'view' THEN '' ELSE 'Area' END AS `LSOA name`,
    {_pick(list(street_crime.CRIME_CODES), 'event_id')} AS `Crime type`, CAST(NULL AS STRING) AS `Last outcome category`, props AS `Context` FROM {{{{events}}}}"""


def _slugged(values, key: str) -> str:
    return _pick([street_crime.slug(v) for v in values], key)


@query(
    "etl_street_crime",
    f"""SELECT CAST(event_id AS VARCHAR) AS id_crime, CAST(date_trunc('month', ts) AS DATE) AS month, CAST(date_trunc('month', ts) AS DATE) AS date,
        {_slugged(street_crime.FORCES, 'user_id')} AS force_reported_by, {_slugged(street_crime.FORCES, 'event_id')} AS force_falls_within,
        CAST(CAST(value / 8 AS FLOAT) AS DOUBLE) AS longitude, CASE WHEN event_type <> 'error' THEN CAST(51.5 AS DOUBLE) END AS latitude,
        'On or near ' || event_type AS location, 'E0' || CAST(user_id AS VARCHAR) AS lower_layer_super_output_area_code,
        CASE WHEN event_type = 'view' THEN '' ELSE 'Area' END AS lower_layer_super_output_area_name,
        {_pick(list(street_crime.CRIME_CODES.values()), 'event_id')} AS crime_type, CAST(NULL AS VARCHAR) AS last_outcome_category,
        props AS context, {_STAMP} FROM events""",
)
def etl_street_crime(spark, sf):
    raw = spark.sql(_CRIMES.format(month="date_format(ts, 'yyyy-MM')").format(events="{events}"), events=table(spark, sf, "events"))
    path = scratch_path(spark, "crimes")
    raw.write.options(header=True, escape='"').csv(path)
    crimes = street_crime.clean(read_csv(spark, path, street_crime.RAW_COLUMNS), _DOWNLOADED)
    return crimes.withColumns({c: F.col(c).cast("double") for c in ("longitude", "latitude")})


@query(
    "etl_month_members",
    """SELECT CAST(event_id AS VARCHAR) AS id_crime, CAST(make_date(2023, 3 + CAST(event_id % 4 AS INTEGER), 1) AS DATE) AS period,
        CAST(make_date(2023, CAST(CASE WHEN event_id % 5 = 0 THEN 2 ELSE 3 + event_id % 4 END AS INTEGER), 1) AS DATE) AS month,
        CASE WHEN event_id % 4 <= 1 THEN '2020-05_2023-04' ELSE 'latest' END AS archive, true AS stamped
       FROM events WHERE event_id % 3 <> 0 AND event_id % 4 <> 3""",
)
def etl_month_members(spark, sf):
    """Members of four months and two kinds in two archives, one with copies of older months; three months are wanted."""
    own = "CASE WHEN event_id % 5 = 0 THEN '2023-02' ELSE concat('2023-0', 3 + event_id % 4) END"
    events = table(spark, sf, "events")
    raw = spark.sql(_CRIMES.format(month=own).format(events="{events}"), events=events)
    number = F.col("Crime ID").cast("bigint")
    kind = F.when(number % 3 == 0, "street-outcomes").otherwise("street")
    member = F.concat(F.lit("2023-0"), (number % 4 + 3).cast("string"), F.lit("-somewhere-"), kind, F.lit(".csv"))
    holders = F.when(number % 4 <= 1, F.array(F.lit("2020-05_2023-04"), F.lit("latest"))).otherwise(F.array(F.lit("latest")))
    path = scratch_path(spark, "members")
    filed = raw.withColumns({"member": member, "archive": F.explode(holders)})
    filed.write.partitionBy("archive", "member").options(header=True, escape='"').csv(path)
    wanted = literal_table(spark, [(date(2023, m, 1),) for m in (3, 4, 5)], "period date")
    files = street_crime.member_files(spark, path, wanted, street_crime.archives(spark))
    crimes = street_crime.clean(street_crime.read_members(spark, files), F.col("downloaded"), ["period", "archive"])
    return crimes.select("id_crime", "period", "month", "archive", F.col("datetime_download").isNotNull().alias("stamped"))


# ---- road collisions -------------------------------------------------------

_RAW_COLLISIONS = """SELECT CAST(o_orderkey AS VARCHAR(20)) AS accident_index, CAST(year(o_orderdate) AS VARCHAR(4)) AS accident_year,
    CASE WHEN o_orderstatus = 'P' THEN 'null' ELSE CAST(o_totalprice AS VARCHAR(30)) END AS longitude,
    CASE WHEN o_orderstatus = 'P' THEN '' ELSE '51.5' END AS latitude,
    CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'O' THEN '2' ELSE '3' END AS accident_severity,
    CASE WHEN o_orderpriority = '5-LOW' THEN '-1' ELSE substr(o_orderpriority, 1, 1) END AS enhanced_severity_collision,
    CAST(o_custkey % 7 - 1 AS VARCHAR(9)) AS first_road_number, CAST(o_custkey % 5 - 1 AS VARCHAR(9)) AS number_of_casualties,
    CASE WHEN o_orderpriority = '2-HIGH' THEN '-1' ELSE 'E' || CAST(o_custkey AS VARCHAR(9)) END AS local_authority_ons_district,
    {date} AS date, {time} AS time, 'kept as it is' AS extra FROM {orders}"""
_COLLISIONS_SQL = """SELECT CAST(o_orderkey AS VARCHAR) AS accident_index, CAST(year(o_orderdate) AS INTEGER) AS accident_year,
    CASE WHEN o_orderstatus <> 'P' THEN CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE) END AS longitude,
    CASE WHEN o_orderstatus <> 'P' THEN CAST(51.5 AS DOUBLE) END AS latitude, accident_severity, enhanced_severity_collision,
    CASE WHEN accident_severity = 'Serious' AND enhanced_severity_collision IS NOT NULL
        THEN accident_severity || ' - ' || enhanced_severity_collision ELSE accident_severity END AS severity,
    CAST(nullif(o_custkey % 7 - 1, -1) AS INTEGER) AS first_road_number, CAST(o_custkey % 5 - 1 AS INTEGER) AS number_of_casualties,
    CASE WHEN o_orderpriority <> '2-HIGH' THEN 'E' || CAST(o_custkey AS VARCHAR) END AS local_authority_ons_district,
    CAST(o_orderdate AS DATE) AS date, strftime(o_orderdate, '%H:%M') || ':00' AS time, 'kept as it is' AS extra
    FROM (SELECT *, CASE o_orderstatus WHEN 'F' THEN 'Fatal' WHEN 'O' THEN 'Serious' ELSE 'Slight' END AS accident_severity,
        CASE WHEN o_orderpriority <> '5-LOW' THEN split_part(o_orderpriority, '-', 2) END AS enhanced_severity_collision FROM orders)"""


_BOOK_COLUMNS = "table string, `field name` string, `code/format` string, label string"


def _collision_book(spark, orders) -> CodeBook:
    """Severity is fixed; the detail codes are those the orders hold, -1 for missing."""
    names = ["table", "field name", "code/format", "label"]
    fixed = [("accident", "accident_severity", c, v) for c, v in (("1", "Fatal"), ("2", "Serious"), ("3", "Slight"), ("-1", "Missing"))]
    detail = orders.select("o_orderpriority").distinct().select(
        F.lit("accident").alias(names[0]), F.lit("enhanced_collision_severity").alias(names[1]),
        F.when(F.col("o_orderpriority") == "5-LOW", "-1").otherwise(F.substring("o_orderpriority", 1, 1)).alias(names[2]),
        F.split_part("o_orderpriority", F.lit("-"), F.lit(2)).alias(names[3]),
    )
    book = literal_table(spark, fixed, _BOOK_COLUMNS).unionByName(detail)
    return CodeBook(read_codebook(book).filter(F.col("table") == "collision"), drop_missing_code=True)


def _collisions(spark, sf):
    orders = table(spark, sf, "orders")
    text = _RAW_COLLISIONS.format(
        date="date_format(o_orderdate, 'dd/MM/yyyy')", time="date_format(o_orderdate, 'HH:mm')", orders="{orders}"
    )
    return road_collisions.clean(spark.sql(text, orders=orders), "collision", _collision_book(spark, orders))


@query("etl_road_collision", _COLLISIONS_SQL)
def etl_road_collision(spark, sf):
    cleaned = _collisions(spark, sf)
    return cleaned.withColumns({c: F.col(c).cast("double") for c in ("longitude", "latitude")})


@query(
    "etl_district_counts",
    f"""SELECT local_authority_ons_district, count(accident_index) AS accidents, CAST(sum(number_of_casualties) AS BIGINT) AS casualties,
        CAST(count(accident_index) * 2 AS BIGINT) AS vehicles FROM ({_COLLISIONS_SQL}) WHERE local_authority_ons_district IS NOT NULL GROUP BY 1""",
)
def etl_district_counts(spark, sf):
    return road_collisions.district_counts(_collisions(spark, sf).withColumn("number_of_vehicles", F.lit(2)))


_CLASS = "CAST(CASE WHEN {m} IS NULL THEN NULL WHEN lo_{m} = hi_{m} THEN 1 ELSE least(floor(6.0 * ({m} - lo_{m}) / (hi_{m} - lo_{m})) + 1, 6) END AS INTEGER) AS {m}_class"
_DISTRICTS_SQL = f"""SELECT 'E' || CAST(c_custkey AS VARCHAR) AS code, c_name, accidents, casualties, vehicles FROM customer LEFT JOIN (
    SELECT local_authority_ons_district AS d, count(*) AS accidents, CAST(sum(number_of_casualties) AS BIGINT) AS casualties,
    count(*) * 2 AS vehicles FROM ({_COLLISIONS_SQL}) WHERE local_authority_ons_district IS NOT NULL GROUP BY 1) ON 'E' || CAST(c_custkey AS VARCHAR) = d"""


@query(
    "etl_district_classes",
    f"""WITH d AS ({_DISTRICTS_SQL}), e AS (SELECT {', '.join(f'min({m}) AS lo_{m}, max({m}) AS hi_{m}' for m in road_collisions.MEASURES)} FROM d)
       SELECT code, c_name, accidents, casualties, vehicles, {', '.join(_CLASS.format(m=m) for m in road_collisions.MEASURES)} FROM d, e""",
)
def etl_district_classes(spark, sf):
    """Customers stand for districts; those without orders keep null classes."""
    districts = table(spark, sf, "customer").selectExpr("'E' || CAST(c_custkey AS STRING) AS code", "c_name")
    counts = road_collisions.district_counts(_collisions(spark, sf).withColumn("number_of_vehicles", F.lit(2)))
    return road_collisions.district_classes(districts, counts, "code").drop("local_authority_ons_district")


_HEAT_SIDE = 16


@query(
    "etl_heat_surfaces",
    f"""WITH p AS (SELECT label, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings),
        s AS (SELECT label, pow(count(*), -1.0 / 3) AS f, var_samp(x) AS vx, var_samp(y) AS vy, covar_samp(x, y) AS vxy,
            min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM p GROUP BY 1),
        r AS (SELECT unnest(range(0, {_HEAT_SIDE})) AS k),
        g AS (SELECT s.*, i.k AS i, j.k AS j, x0 + j.k * ((x1 - x0) / {_HEAT_SIDE - 1}) AS gx, y0 + i.k * ((y1 - y0) / {_HEAT_SIDE - 1}) AS gy
            FROM s, r i, r j),
        m AS (SELECT g.label, i, j, gx, gy, sum(exp(-0.5 * (vy * (gx - x) * (gx - x) - 2 * vxy * (gx - x) * (gy - y) + vx * (gy - y) * (gy - y))
            / (f * (vx * vy - vxy * vxy)))) AS mass FROM g JOIN p ON g.label = p.label GROUP BY 1, 2, 3, 4, 5),
        d AS (SELECT *, mass / max(mass) OVER (PARTITION BY label) AS density FROM m)
       SELECT 'D' || label AS code, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, round(gy, 9) AS latitude, round(gx, 9) AS longitude,
        round(density, 9) AS intensity FROM d WHERE abs(gx) + abs(gy) < 0.1 + label * 0.02""",
)
def etl_heat_surfaces(spark, sf):
    """Vectors stand for collisions, labels for districts; each district is a diamond."""
    vectors = table(spark, sf, "embeddings", "label", "embedding")
    collisions = vectors.selectExpr(
        "'D' || CAST(label AS STRING) AS local_authority_ons_district", "CAST(embedding[0] AS DOUBLE) AS longitude",
        "CAST(embedding[1] AS DOUBLE) AS latitude",
    )
    reach = vectors.select("label").distinct().selectExpr("'D' || CAST(label AS STRING) AS code", "CAST(0.1 + label * 0.02 AS DOUBLE) AS r")
    corners = ((1, 0, 0, 1), (0, 1, -1, 0), (-1, 0, 0, -1), (0, -1, 1, 0))
    sides = ", ".join(f"named_struct('x1', {a} * r, 'y1', {b} * r, 'x2', {c} * r, 'y2', {d} * r)" for a, b, c, d in corners)
    edges = reach.selectExpr("code", f"inline(array({sides}))")
    surface = road_collisions.heat_surfaces(collisions, edges, "code", _HEAT_SIDE)
    return surface.withColumns({c: F.round(c, 9) for c in ("latitude", "longitude", "intensity")})


_CASUALTY_BOOK = {"casualty_class": {"1": "Driver or rider", "2": "Passenger", "3": "Pedestrian", "-1": "Missing"}}


@query(
    "etl_road_casualty",
    """SELECT CAST(l_orderkey AS VARCHAR) AS accident_index, CAST(l_linenumber AS INTEGER) AS vehicle_reference,
        CASE l_returnflag WHEN 'A' THEN 'Driver or rider' WHEN 'N' THEN 'Passenger' END AS casualty_class,
        CAST(l_quantity AS INTEGER) - 2 AS age_of_casualty FROM lineitem""",
)
def etl_road_casualty(spark, sf):
    """Unlisted columns of the declaration may be absent; -1 stays in numbers."""
    lines = table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")
    raw = lines.select(
        F.col("l_orderkey").cast("string").alias("accident_index"),
        F.col("l_linenumber").cast("string").alias("vehicle_reference"),
        F.expr("CASE l_returnflag WHEN 'A' THEN '1' WHEN 'N' THEN '2' ELSE '-1' END").alias("casualty_class"),
        (F.col("l_quantity").cast("int") - 2).cast("string").alias("age_of_casualty"),
    )
    rows = [("casualty", f, c, v) for f, codes in _CASUALTY_BOOK.items() for c, v in codes.items()]
    book = literal_table(spark, rows, _BOOK_COLUMNS)
    return road_collisions.clean(raw, "casualty", road_collisions.load_codebook(book, "casualty"))


# ---- postcode directory ----------------------------------------------------

_DIRECT_RAW = {
    "pcds": "c_mktsegment || ' ' || CAST(c_custkey AS VARCHAR(9))",
    "pcd": "CAST(c_custkey AS VARCHAR(9))",
    "pcd2": "c_name",
    "dointr": "'198001'",
    "doterm": "CASE WHEN c_acctbal < 0 THEN '202207' WHEN c_nationkey = 3 THEN NULL ELSE '' END",
    "lat": "CASE WHEN c_nationkey = 4 THEN '99.999999' ELSE '51.25' END",
    "long": "'-0.125'",
    "oseast1m": "CASE WHEN c_nationkey = 4 THEN '' ELSE CAST(c_custkey AS VARCHAR(9)) END",
    "osnrth1m": "CAST(c_custkey * 2 AS VARCHAR(9))",
    "osgrdind": "CASE WHEN c_nationkey = 4 THEN '9' ELSE '1' END",
    "usertype": "CAST(c_custkey % 2 AS VARCHAR(9))",
    "ctry": "CASE WHEN c_nationkey < 10 THEN 'E92000001' ELSE 'W92000004' END",
    "imd": "CAST(c_nationkey AS VARCHAR(9))",
}
_CODE_RAW = "'X' || CAST(c_nationkey AS VARCHAR(9))"
_LABELS = {1: "n_name", 2: "lower(n_name)", 3: "'sub ' || n_name"}


def _raw_code(source: str) -> str:
    blank = {"streg": "NULL", "ur01ind": "' '"}.get(source, "''")
    pseudo = "WHEN c_mktsegment = 'MACHINERY' THEN 'L99999999' " if _has_channel_islands(source) else ""
    return f"CASE WHEN c_mktsegment = 'BUILDING' THEN {blank} {pseudo}ELSE {_CODE_RAW} END"


def _has_channel_islands(source: str) -> bool:
    return any("channel_islands" in r.pseudo for r in postcodes.RECODED if r.source == source)


def _directory_raw() -> dict[str, str]:
    codes = {s: _raw_code(s) for s in postcodes.CODE_COLUMNS if s not in _DIRECT_RAW}
    return {**_DIRECT_RAW, **codes}


def _directory_sql() -> str:
    raw = _directory_raw()
    direct = {
        "postcode": raw["pcds"], "postcode_7_character": raw["pcd"], "postcode_8_character": raw["pcd2"],
        "date_start": "DATE '1980-01-01'", "date_end": "CASE WHEN c_acctbal < 0 THEN DATE '2022-07-01' END",
        "is_live": f"({raw['doterm']}) = ''", "latitude": f"CAST(CAST({raw['lat']} AS FLOAT) AS DOUBLE)", "longitude": "CAST(-0.125 AS DOUBLE)",
        "easting": "CASE WHEN c_nationkey <> 4 THEN CAST(c_custkey AS INTEGER) END", "northing": "CAST(c_custkey * 2 AS INTEGER)",
        "grid_reference_indicator": f"CASE WHEN c_nationkey = 4 THEN '{postcodes.GRID_REFERENCE_INDICATOR['9']}' ELSE '{postcodes.GRID_REFERENCE_INDICATOR['1']}' END",
        "postcode_user_type": "CASE c_custkey % 2 WHEN 0 THEN 'small_user' ELSE 'large_user' END",
        "country": "CASE WHEN c_nationkey < 10 THEN 'England' ELSE 'Wales' END",
        "index_of_multiple_deprivation": "CAST(nullif(c_nationkey, 0) AS INTEGER)", "datetime_download": "TIMESTAMP '2024-11-01 00:00:00'",
    }
    for r in postcodes.RECODED:
        label = f"CASE WHEN n_regionkey = 2 THEN 'Unknown' ELSE {_LABELS[r.position]} END" if r.absent_is_unknown else _LABELS[r.position]
        pseudo = "WHEN c_mktsegment = 'MACHINERY' THEN '(pseudo) Channel Islands' " if "channel_islands" in r.pseudo else ""
        direct[r.output] = f"CASE WHEN c_mktsegment = 'BUILDING' THEN 'Unknown' {pseudo}ELSE {label} END"
    for source, name in postcodes.CODE_COLUMNS.items():
        direct[name] = raw[source]
    columns = ", ".join(f"{e} AS {n}" for n, e in direct.items())
    return f"SELECT {columns} FROM customer JOIN nation ON c_nationkey = n_nationkey"


@query("etl_postcode_directory", _directory_sql())
def etl_postcode_directory(spark, sf):
    """All 93 columns, each lookup file taken from the nations; files whose absent
    codes fall back to Unknown lack one region."""
    raw = table(spark, sf, "customer").selectExpr(*[f"{e} AS {n}" for n, e in _directory_raw().items()])
    nation = table(spark, sf, "nation")
    whole = nation.selectExpr("'X' || CAST(n_nationkey AS STRING) AS code", *[f"{e} AS l{i}" for i, e in _LABELS.items()])
    partial = nation.filter("n_regionkey <> 2").selectExpr(
        "'X' || CAST(n_nationkey AS STRING) AS code", *[f"{e} AS l{i}" for i, e in _LABELS.items()]
    )
    lookups = {r.file_part: partial if r.absent_is_unknown else whole for r in postcodes.RECODED}
    directory = postcodes.clean_directory(raw, lookups, _DOWNLOADED)
    return directory.withColumns({c: F.col(c).cast("double") for c in ("latitude", "longitude")})


@query(
    "etl_code_point",
    f"""SELECT CAST(c_custkey AS VARCHAR) AS "Postcode", CAST({EAST} AS BIGINT) AS "Eastings", CAST({NORTH} AS BIGINT) AS "Northings",
        longitude AS "Longitude", latitude AS "Latitude" FROM customer JOIN ({grid_sql()}) AS located USING (c_custkey)""",
)
def etl_code_point(spark, sf):
    """Integer grid coordinates, with longitude and latitude to a centimetre."""
    raw = table(spark, sf, "customer").selectExpr(
        "CAST(c_custkey AS STRING) AS Postcode", f"CAST({EAST} AS STRING) AS Eastings", f"CAST({NORTH} AS STRING) AS Northings"
    )
    path = scratch_path(spark, "code-point")
    raw.write.csv(f"{path}/data")
    sidecar = literal_table(spark, [("PC,EA,NO",), ("Postcode,Eastings,Northings",)], "value string")
    sidecar.coalesce(1).write.text(f"{path}/doc")
    placed = postcodes.clean_code_point(postcodes.read_code_point(spark, f"{path}/data", f"{path}/doc"))
    return placed.withColumns({c: F.round(c, 7) for c in ("Longitude", "Latitude")})


# ---- school performance ----------------------------------------------------


@query(
    "etl_school_manifest",
    f"""WITH s AS (SELECT o_orderpriority AS types, unnest(generate_series(date_trunc('year', min(o_orderdate)), max(o_orderdate), INTERVAL 1 YEAR)) AS p
            FROM orders GROUP BY 1), y AS (SELECT types, CAST(p AS DATE) AS period, (year(p) - 1) || '-' || year(p) AS span FROM s)
       SELECT period, types, '{schools.INFO_SERVER}?currentstep=region&downloadYear=' || span || '&regiontype=all&la=0' AS url_info,
        '{schools.SERVER}?download=true&regions=0&filters=' || types || '&fileformat=csv&year=' || span || '&meta=false' AS url,
        CAST(NULL AS VARCHAR) AS url_meta, strftime(period, '%Y-%m-%d') || '_data.zip' AS file_name, CAST(NULL AS VARCHAR) AS file_name_meta FROM y""",
)
def etl_school_manifest(spark, sf):
    span = table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("types")).agg(
        F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi")
    )
    periods = calendars.years(span, F.col("lo"), F.col("hi"), schools.PERIOD)
    return schools.manifest(periods, "types")
