"""Casts, null tokens and the whole-table loader on deliberately dirty text."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from quarryline.functions import casts
from quarryline.operators import codebook, loader
from quarryline.plans.registry import query, table
from quarryline.sources.literal import literal_table

# Junk and good text by event, the same expression in both engines.
_DIRTY = """CASE event_id % 12 WHEN 0 THEN 'null' WHEN 1 THEN 'NULL' WHEN 2 THEN 'None' WHEN 3 THEN 'NONE'
    WHEN 4 THEN 'nan' WHEN 5 THEN 'NaN' WHEN 6 THEN '' WHEN 7 THEN '-1' WHEN 8 THEN NULL ELSE event_type END"""
_NUMBER = """CASE event_id % 10 WHEN 0 THEN 'null' WHEN 1 THEN '3.5' WHEN 2 THEN ' 3 ' WHEN 3 THEN '-1'
    WHEN 4 THEN '1.5d' WHEN 5 THEN '99999999999' WHEN 6 THEN NULL ELSE CAST(user_id AS VARCHAR(20)) END"""
_FLAG = """CASE event_id % 11 WHEN 0 THEN 'true' WHEN 1 THEN 'False' WHEN 2 THEN '1' WHEN 3 THEN '0' WHEN 4 THEN '2'
    WHEN 5 THEN 'null' WHEN 6 THEN 'None' WHEN 7 THEN 'NaN' WHEN 8 THEN '' WHEN 9 THEN '-1' ELSE 'TRUE' END"""
_DATE = """CASE event_id % 7 WHEN 0 THEN '' WHEN 1 THEN 'None' WHEN 2 THEN '31/02/2024' WHEN 3 THEN '2024-01-05'
    WHEN 4 THEN NULL ELSE {good} END"""
_TIME = """CASE event_id % 6 WHEN 0 THEN '' WHEN 1 THEN 'NULL' WHEN 2 THEN '25:10' WHEN 3 THEN NULL ELSE {good} END"""
_SPARK_DATE = _DATE.format(good="date_format(ts, 'dd/MM/yyyy')")
_DUCK_DATE = _DATE.format(good="strftime(ts, '%d/%m/%Y')")
_SPARK_TIME = _TIME.format(good="date_format(ts, 'HH:mm')")
_DUCK_TIME = _TIME.format(good="strftime(ts, '%H:%M')")
_CODE = "CASE event_type WHEN 'click' THEN '1' WHEN 'view' THEN '2' WHEN 'error' THEN '-1' ELSE '9' END"

_TEXT_SQL = "CASE WHEN t IN ('null', 'NULL', 'NONE', 'None', 'nan', 'NaN', '', '-1') THEN NULL ELSE t END"
_INT_SQL = "CASE WHEN regexp_full_match(t, '[+-]?[0-9]+') THEN TRY_CAST(t AS INTEGER) END"
_FLOAT_SQL = "CASE WHEN regexp_full_match(t, '[+-]?[0-9]+[.]?[0-9]*') THEN TRY_CAST(t AS FLOAT) END"
_FLAG_SQL = """CASE WHEN lower(t) IN ('null', 'none', 'nan', '', '-1') THEN NULL
    WHEN lower(t) = 'true' THEN true WHEN lower(t) = 'false' THEN false ELSE CAST(t AS INTEGER) <> 0 END"""
_DATE_SQL = "CAST(try_strptime(t, '%d/%m/%Y') AS DATE)"
_TIME_SQL = f"strftime(try_strptime({_TEXT_SQL}, '%H:%M'), '%H:%M:%S')"


def _on(dirty: str, cleaned: str) -> str:
    return f"SELECT event_id, {cleaned} AS v FROM (SELECT event_id, {dirty} AS t FROM events)"


def _text(spark, sf, expression: str):
    return table(spark, sf, "events", "event_id", "event_type", "user_id", "ts").select(
        "event_id", F.expr(expression).alias("t")
    )


@query(
    "cst_strict",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(CAST(user_id AS VARCHAR) AS DOUBLE) AS u
       FROM events""",
)
def cst_strict(spark, sf):
    events = table(spark, sf, "events", "event_id", "props", "user_id")
    return events.select(
        "event_id",
        casts.strict(F.get_json_object("props", "$.k"), "int").alias("k"),
        casts.strict(F.col("user_id").cast("string"), "double").alias("u"),
    )


@query("cst_lenient", _on(_NUMBER, _INT_SQL))
def cst_lenient(spark, sf):
    return _text(spark, sf, _NUMBER).select("event_id", casts.lenient(F.col("t"), "int").alias("v"))


@query("cst_lenient_float", _on(_NUMBER, f"CAST({_FLOAT_SQL} AS DOUBLE)"))
def cst_lenient_float(spark, sf):
    return _text(spark, sf, _NUMBER).select("event_id", casts.lenient(F.col("t"), "float").cast("double").alias("v"))


@query("cst_string_tokens", _on(_DIRTY, _TEXT_SQL))
def cst_string_tokens(spark, sf):
    return _text(spark, sf, _DIRTY).select("event_id", casts.clean_string(F.col("t")).alias("v"))


@query("cst_boolean", _on(_FLAG, _FLAG_SQL))
def cst_boolean(spark, sf):
    return _text(spark, sf, _FLAG).select("event_id", casts.clean_boolean(F.col("t")).alias("v"))


@query("cst_date", _on(_DUCK_DATE, _DATE_SQL))
def cst_date(spark, sf):
    return _text(spark, sf, _SPARK_DATE).select("event_id", casts.clean_date(F.col("t"), "%d/%m/%Y").alias("v"))


@query("cst_time", _on(_DUCK_TIME, _TIME_SQL))
def cst_time(spark, sf):
    return _text(spark, sf, _SPARK_TIME).select("event_id", casts.clean_time(F.col("t"), "%H:%M").alias("v"))


def _book(spark):
    rows = [("events", "code", "-1", "Missing"), ("events", "code", "1", "Click"), ("events", "code", "2", "View")]
    return literal_table(spark, rows, "table string, field string, code string, label string")


@query(
    "cst_enum",
    f"""SELECT event_id, CASE code WHEN '1' THEN 'Click' WHEN '2' THEN 'View' END AS code, event_type
        FROM (SELECT event_id, event_type, {_CODE} AS code FROM events)""",
)
def cst_enum(spark, sf):
    """A field in the code-book is recoded; one outside it keeps its observed values."""
    coded = table(spark, sf, "events", "event_id", "event_type").withColumn("code", F.expr(_CODE))
    fields = codebook.CodeBook(_book(spark), drop_missing_code=True)
    return loader.clean_table(coded, {"code": "coded", "event_type": "coded"}, codebook=fields)


_SCHEMA = {
    "words": "string", "number": "int", "ratio": "float", "flag": "boolean",
    "code": "coded", "day": "date", "moment": "time",
}
_RAW = {"words": _DIRTY, "number": _NUMBER, "ratio": _NUMBER, "flag": _FLAG, "code": _CODE}


def _cleaned(spark, sf):
    events = table(spark, sf, "events", "event_id", "event_type", "user_id", "ts")
    expressions = {**_RAW, "day": _SPARK_DATE, "moment": _SPARK_TIME}
    raw = events.select("event_id", *[F.expr(e).alias(n) for n, e in expressions.items()])
    return loader.clean_table(
        raw,
        _SCHEMA,
        formats={"day": "%d/%m/%Y", "moment": "%H:%M"},
        codebook=codebook.CodeBook(_book(spark), drop_missing_code=True),
        column_operations={"number": F.when(F.col("number") != -1, F.col("number")), "twice": F.col("number") * 2},
        renames={"words": "text"},
        frame_operations=[lambda df: df.withColumn("ratio", F.col("ratio").cast("double"))],
    )


def _of(column: str, expression: str) -> str:
    """The cleaning expression of ``t`` applied to another column."""
    return re.sub(r"\bt\b", column, expression)


_CLEAN_SQL = f"""SELECT event_id, nullif(number, -1) AS number, number * 2 AS twice, ratio, flag, code, day, moment, text FROM (
    SELECT event_id, {_of('words', _TEXT_SQL)} AS text, {_of('digits', _INT_SQL)} AS number,
        CAST({_of('digits', _FLOAT_SQL)} AS DOUBLE) AS ratio, {_of('flags', _FLAG_SQL)} AS flag,
        CASE codes WHEN '1' THEN 'Click' WHEN '2' THEN 'View' END AS code,
        {_of('days', _DATE_SQL)} AS day, {_of('moments', _TIME_SQL)} AS moment
    FROM (SELECT event_id, {_DIRTY} AS words, {_NUMBER} AS digits, {_FLAG} AS flags, {_CODE} AS codes, {_DUCK_DATE} AS days,
        {_DUCK_TIME} AS moments FROM events))"""


@query("cst_clean_table", _CLEAN_SQL)
def cst_clean_table(spark, sf):
    return _cleaned(spark, sf)


@query(
    "agg_null_census",
    "SELECT "
    + ", ".join(
        f"count(*) FILTER (WHERE {c} IS NULL) AS {c}"
        for c in ("event_id", "text", "number", "ratio", "flag", "code", "day", "moment", "twice")
    )
    + f" FROM ({_CLEAN_SQL})",
)
def agg_null_census(spark, sf):
    return loader.null_census(_cleaned(spark, sf))
