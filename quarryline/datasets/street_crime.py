"""Street-level crime: monthly members inside dated archives."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quarryline.functions import casts, dates
from quarryline.functions.codes import recode_strict, slug
from quarryline.functions.nulls import pair_mismatch
from quarryline.operators import calendars, joins
from quarryline.operators.quality import digest_state
from quarryline.sinks import landing
from quarryline.sources.files import is_member, listing
from quarryline.sources.literal import literal_table
from quarryline.sources.text import read_csv, text_schema

# Police forces as written in the files; labels follow ``slug``.
FORCES = (
    "Avon and Somerset Constabulary",
    "Bedfordshire Police",
    "British Transport Police",
    "Cambridgeshire Constabulary",
    "Cheshire Constabulary",
    "City of London Police",
    "Cleveland Police",
    "Cumbria Constabulary",
    "Derbyshire Constabulary",
    "Devon & Cornwall Police",
    "Dorset Police",
    "Durham Constabulary",
    "Dyfed-Powys Police",
    "Essex Police",
    "Gloucestershire Constabulary",
    "Greater Manchester Police",
    "Gwent Police",
    "Hampshire Constabulary",
    "Hertfordshire Constabulary",
    "Humberside Police",
    "Kent Police",
    "Lancashire Constabulary",
    "Leicestershire Police",
    "Lincolnshire Police",
    "Merseyside Police",
    "Metropolitan Police Service",
    "Norfolk Constabulary",
    "North Wales Police",
    "North Yorkshire Police",
    "Northamptonshire Police",
    "Northumbria Police",
    "Nottinghamshire Police",
    "Police Service of Northern Ireland",
    "South Wales Police",
    "South Yorkshire Police",
    "Staffordshire Police",
    "Suffolk Constabulary",
    "Surrey Police",
    "Sussex Police",
    "Thames Valley Police",
    "Warwickshire Police",
    "West Mercia Police",
    "West Midlands Police",
    "West Yorkshire Police",
    "Wiltshire Police",
)
# Crime types as written in the files; labels follow ``slug``.
CRIME_TYPES = (
    "All crime",
    "Anti-social behaviour",
    "Bicycle theft",
    "Burglary",
    "Criminal damage and arson",
    "Drugs",
    "Other crime",
    "Other theft",
    "Possession of weapons",
    "Public order",
    "Robbery",
    "Shoplifting",
    "Theft from the person",
    "Vehicle crime",
    "Violence and sexual offences",
)
# Older types folded into a current one.
OLDER_CRIME_TYPES = {
    "Violent crime": "violence_and_sexual_offences",
    "Public disorder and weapons": "public_order",
}
FORCE_CODES = {name: slug(name) for name in FORCES}
CRIME_CODES = {**{name: slug(name) for name in CRIME_TYPES}, **OLDER_CRIME_TYPES}
DOMAINS = {
    "force_reported_by": tuple(FORCE_CODES.values()),
    "force_falls_within": tuple(FORCE_CODES.values()),
    "crime_type": tuple(sorted(set(CRIME_CODES.values()))),
}
# Closed archives, first and last month, and their MD5 digests.
ARCHIVES = {
    ("2010-12", "2017-04"): "955e065e0f08d67872da9187263dc359",
    ("2017-05", "2020-04"): "eee35279b6828ba49fd2ad7ef3133262",
    ("2020-05", "2023-04"): "b6fc748c2f588cf06e3492a6e4f253ae",
}
RAW_COLUMNS = (
    "Crime ID", "Month", "Reported by", "Falls within", "Longitude", "Latitude", "Location",
    "LSOA code", "LSOA name", "Crime type", "Last outcome category", "Context",
)
FIRST_MONTH = "2010-12-01"
MONTHS_BEHIND = 6
ARCHIVE_SERVER = "https://data.police.uk/data/archive"
PERIOD = "period"


def read_raw(spark: SparkSession, paths: str | Sequence[str], months: Sequence[date] = ()) -> DataFrame:
    """Street files, of the given months only if there are some; other members are passed over.

    The name starts with the month and ends in ``-street`` before the extension.
    ``_metadata.file_modification_time`` of the rows can serve as the time of download.
    """
    prefix = "{" + ",".join(f"{m:%Y-%m}" for m in months) + "}" if months else "[0-9][0-9][0-9][0-9]-[0-9][0-9]"
    return read_csv(spark, paths, RAW_COLUMNS, name_glob=f"{prefix}*-street.csv", recursiveFileLookup=True)


def _placed(path: Column) -> dict[str, Column]:
    """``archive`` and ``member`` of a path: a folder ``<archive>`` or ``archive=<archive>``, and in
    it a file, or a folder of part files, whose name begins with a month."""
    pattern = r"/(?:archive=)?([^/=]+)/(?:member=)?([0-9]{4}-[0-9]{2}[^/]*\.csv)(?:/[^/]+)?$"
    return {"archive": F.regexp_extract(path, pattern, 1), "member": F.regexp_extract(path, pattern, 2)}


def member_files(spark: SparkSession, folder: str, wanted: DataFrame, archive_table: DataFrame, period: str = PERIOD) -> DataFrame:
    """``period, archive, member, path, modified`` of the street members of each wanted month.

    A month is taken from the first archive that holds it, else from ``latest``; other copies of
    the month, other kinds of member and other months are passed over.  Contents are not read.
    """
    found = listing(spark, folder, "*.csv").withColumns(_placed(F.col("path"))).filter("member != ''")
    chosen = archive_of_month(wanted.select(period).distinct(), archive_table, period).select(period, "archive")
    found = found.withColumn("_month", F.substring("member", 1, 7))
    joined = found.join(chosen.withColumn("_month", F.date_format(period, "yyyy-MM")), ["archive", "_month"])
    return joined.filter(is_member(F.col("member"), F.col(period))).select(period, "archive", "member", "path", "modified")


def read_members(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Rows of the listed members, and only those, with ``period`` (the member's month, which may differ
    from a row's own), ``archive`` and ``downloaded`` (the file's time).

    The names come to the driver, as for any scan of files; no member gives no rows.
    """
    extra = [PERIOD, "archive", "downloaded"]
    paths = [r["path"] for r in files.select("path").distinct().collect()]
    if not paths:
        types = text_schema(RAW_COLUMNS).add(PERIOD, "date").add("archive", "string").add("downloaded", "timestamp")
        return spark.createDataFrame([], types)
    path, modified = F.col("_metadata.file_path"), F.col("_metadata.file_modification_time")
    rows = read_csv(spark, paths, RAW_COLUMNS).withColumns(_placed(path) | {"downloaded": modified})
    month = casts.strict_date(F.substring("member", 1, 7), "%Y-%m")
    return rows.withColumn(PERIOD, month).select(*RAW_COLUMNS, *extra)


def clean(raw: DataFrame, downloaded: datetime | Column, keep: Sequence[str] = ()) -> DataFrame:
    """Typed and coded crimes, with the columns ``keep`` as they are; an unknown force or type fails the job."""
    month = casts.strict_date(F.col("Month"), "%Y-%m")
    return raw.select(
        F.col("Crime ID").alias("id_crime"),
        month.alias("month"),
        month.alias("date"),
        recode_strict(F.col("Reported by"), FORCE_CODES, "Reported by").alias("force_reported_by"),
        recode_strict(F.col("Falls within"), FORCE_CODES, "Falls within").alias("force_falls_within"),
        casts.strict(F.col("Longitude"), "float").alias("longitude"),
        casts.strict(F.col("Latitude"), "float").alias("latitude"),
        F.col("Location").alias("location"),
        F.col("LSOA code").alias("lower_layer_super_output_area_code"),
        F.col("LSOA name").alias("lower_layer_super_output_area_name"),
        recode_strict(F.col("Crime type"), CRIME_CODES, "Crime type").alias("crime_type"),
        F.col("Last outcome category").alias("last_outcome_category"),
        F.col("Context").alias("context"),
        dates.stamp(downloaded).alias("datetime_download"),
        *keep,
    )


def months(spark: SparkSession, as_of: date) -> DataFrame:
    frame = literal_table(spark, [(as_of,)], "as_of date")
    end = F.add_months("as_of", -MONTHS_BEHIND)
    return calendars.months(frame, F.lit(FIRST_MONTH), end, PERIOD).select(PERIOD)


def archive_name(start: Column, end: Column, as_of: Column) -> Column:
    """``<start>_<end>.zip``, ``latest_<as_of>.zip`` without a range; half a range fails."""
    dated = F.concat(F.date_format(start, "yyyy-MM-dd"), F.lit("_"), F.date_format(end, "yyyy-MM-dd"), F.lit(".zip"))
    newest = F.concat(F.lit("latest_"), F.date_format(as_of, "yyyy-MM-dd"), F.lit(".zip"))
    half = F.raise_error(F.lit("start and end should both be null or neither")).cast("string")
    return F.when(pair_mismatch(start, end), half).when(start.isNull(), newest).otherwise(dated)


def archives(spark: SparkSession) -> DataFrame:
    """``seq, label, start, end, expected`` of the closed archives."""
    rows = [(i, f"{a}_{b}", a, b, digest) for i, ((a, b), digest) in enumerate(ARCHIVES.items())]
    frame = literal_table(spark, rows, "seq int, label string, start string, end string, expected string")
    return frame.withColumns({c: casts.strict_date(F.col(c), "%Y-%m") for c in ("start", "end")})


def archive_of_month(periods: DataFrame, archive_table: DataFrame, period: str = PERIOD) -> DataFrame:
    """The first archive holding each month, else ``latest``."""
    return joins.interval_with_fallback(periods, period, archive_table, "archive")


def archive_urls(archive_table: DataFrame, server: str = ARCHIVE_SERVER) -> DataFrame:
    name = F.date_format("end", "yyyy-MM")
    return archive_table.select("label", F.concat(F.lit(server + "/"), name, F.lit(".zip")).alias("url"))


def verify(contents: DataFrame) -> DataFrame:
    """``label, content, expected`` with the digest state; no digest is its own state."""
    return digest_state(contents, "content", "expected")


def members_of_month(members: DataFrame, name: str, month: Column) -> DataFrame:
    return members.filter(is_member(F.col(name), month))


def land(crimes: DataFrame, wanted: DataFrame, path: str) -> DataFrame:
    return landing.land(crimes.withColumn(PERIOD, F.col("month")), wanted, path, PERIOD)


def read(spark: SparkSession, path: str) -> DataFrame:
    return landing.read_complete(spark, path)
