"""House sales: headerless yearly files, one row per sale."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quarryline.functions import casts, dates
from quarryline.functions.codes import recode_strict, unmapped
from quarryline.functions.text import trim_spaces
from quarryline.operators import aggregates, calendars, joins, orderstats
from quarryline.operators.rows import sort_coded
from quarryline.sinks import landing
from quarryline.sources.literal import literal_table
from quarryline.sources.text import read_csv

# The sixteen fields of a raw line, in order.
COLUMNS = (
    "id_transaction", "price", "date", "postcode", "property_type", "old_new", "tenure_duration",
    "primary_addressable_object_name", "secondary_addressable_object_name", "street", "locality",
    "town_city", "district", "county", "transaction_type", "record_status_monthly_file_only",
)
# Code -> label, in the order labels compare by.
CODES = {
    "property_type": {"D": "detached", "S": "semi_detached", "T": "terraced", "F": "flats_or_maisonettes", "O": "other"},
    "old_new": {"Y": "new", "N": "old"},
    "tenure_duration": {"F": "freehold", "L": "leasehold", "U": "unknown"},
    "transaction_type": {"A": "standard_price_paid_entry", "B": "additional_price_paid_entry"},
    "record_status_monthly_file_only": {"A": "addition", "C": "change", "D": "delete"},
}
DOMAINS = {name: tuple(codes.values()) for name, codes in CODES.items()}
FIRST_YEAR = "1995-01-01"
SERVER = "http://prod.publicdata.landregistry.gov.uk.s3-website-eu-west-1.amazonaws.com"
PERIOD = "period"


def read_raw(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return read_csv(spark, paths, COLUMNS, header=False)


def clean(raw: DataFrame, downloaded: datetime | Column) -> DataFrame:
    """Typed and coded sales; an unknown code or a bad number or date fails the job."""
    special = {
        "price": casts.strict(F.col("price"), "double"),
        "date": casts.strict_date(F.col("date"), "%Y-%m-%d %H:%M"),
        "postcode": trim_spaces(F.col("postcode")),
        **{name: recode_strict(F.col(name), codes, name) for name, codes in CODES.items()},
    }
    return raw.select(
        *[special.get(c, F.col(c)).alias(c) for c in COLUMNS], dates.stamp(downloaded).alias("datetime_download")
    )


def unknown_codes(raw: DataFrame) -> DataFrame:
    """Rows a clean run would refuse, with the names of the offending columns."""
    flags = [F.when(unmapped(F.col(n), codes), F.lit(n)) for n, codes in CODES.items()]
    return raw.withColumn("unknown", F.array_compact(F.array(*flags))).filter(F.size("unknown") > 0)


def years(spark: SparkSession, as_of: date) -> DataFrame:
    frame = literal_table(spark, [(as_of,)], "as_of date")
    return calendars.years(frame, F.lit(FIRST_YEAR), F.col("as_of"), PERIOD).select(PERIOD)


def manifest(periods: DataFrame, server: str = SERVER) -> DataFrame:
    """Source file and address of every yearly period."""
    name = F.format_string("pp-%d.csv", F.year(PERIOD))
    return periods.select(PERIOD, name.alias("file_name"), F.concat(F.lit(server + "/"), name).alias("url"))


def land(sales: DataFrame, wanted: DataFrame, path: str) -> DataFrame:
    """Land every wanted year not landed yet; returns those years."""
    return landing.land(sales.withColumn(PERIOD, dates.year_start(F.col("date"))), wanted, path, PERIOD)


def read(spark: SparkSession, path: str) -> DataFrame:
    return landing.read_complete(spark, path)


# ---- analyses --------------------------------------------------------------


def with_periods_and_place(sales: DataFrame, postcodes: DataFrame) -> DataFrame:
    """Month and year starts, and the postcode's coordinates where known."""
    dated = sales.withColumns({"month": dates.month_start(F.col("date")), "year": dates.year_start(F.col("date"))})
    return joins.left_lookup(dated, postcodes, "postcode", ["longitude", "latitude"])


def unplaced_postcodes(sales: DataFrame, postcodes: DataFrame) -> DataFrame:
    return joins.unmatched_keys(sales, postcodes, "postcode", "longitude")


def sales_per(df: DataFrame, period: str) -> DataFrame:
    return aggregates.row_count(df, [period])


def sales_per_category(df: DataFrame, period: str = "year") -> DataFrame:
    return aggregates.row_count_by_category(df, period, list(CODES))


def price_quantiles(df: DataFrame, by: Sequence[str] = ("month",)) -> DataFrame:
    return sort_coded(orderstats.quantiles_nearest(df, list(by), "price"), list(by), DOMAINS)


def log_median_by_place(df: DataFrame, county: str, transaction_type: str = "standard_price_paid_entry") -> DataFrame:
    chosen = df.filter((F.col("county") == county) & (F.col("transaction_type") == transaction_type))
    return orderstats.log_median(chosen, ["year", "longitude", "latitude"], "price", "price").orderBy("year")
