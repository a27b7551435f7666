"""School performance: yearly archives asked for by data type."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from quarryline.functions.dates import academic_year
from quarryline.functions.text import harvest_attribute
from quarryline.operators import calendars
from quarryline.sources.literal import literal_table

FIRST_YEAR = "1992-01-01"
# Years that were never published.
MISSING_YEARS = ("1995-01-01", "2020-01-01")
FIRST_CSV_YEAR = 1995
FIRST_META_YEAR = 2011
SERVER = "https://www.find-school-performance-data.service.gov.uk/download-data"
INFO_SERVER = "https://www.compare-school-performance.service.gov.uk/download-data"
PERIOD = "period"


def years(spark: SparkSession, as_of: date) -> DataFrame:
    frame = literal_table(spark, [(as_of,)], "as_of date")
    spine = calendars.years(frame, F.lit(FIRST_YEAR), F.add_months("as_of", -12), PERIOD)
    return calendars.without(spine, PERIOD, MISSING_YEARS).select(PERIOD)


def data_types(pages: DataFrame, html: str, output: str = "data_types") -> DataFrame:
    """The data types a page offers, upper-cased, sorted and comma-joined."""
    return pages.withColumn(output, harvest_attribute(F.col(html), "input", ("name", "datatypes"), "value"))


def manifest(periods: DataFrame, data_types_column: str) -> DataFrame:
    """Addresses and file names per year; years before 2011 have no meta file."""
    span, types = academic_year(F.col(PERIOD)), F.col(data_types_column)
    fmt = F.when(F.year(PERIOD) < FIRST_CSV_YEAR, "xls").otherwise("csv")
    stem = F.date_format(PERIOD, "yyyy-MM-dd")
    has_meta = F.year(PERIOD) >= FIRST_META_YEAR
    return periods.select(
        PERIOD,
        types,
        F.concat(F.lit(f"{INFO_SERVER}?currentstep=region&downloadYear="), span, F.lit("&regiontype=all&la=0")).alias("url_info"),
        F.concat(
            F.lit(f"{SERVER}?download=true&regions=0&filters="), types, F.lit("&fileformat="), fmt,
            F.lit("&year="), span, F.lit("&meta=false"),
        ).alias("url"),
        F.when(
            has_meta,
            F.concat(
                F.lit(f"{SERVER}?download=true&regions="), types,
                F.lit("&filters=meta&fileformat=csv&year="), span, F.lit("&meta=true"),
            ),
        ).alias("url_meta"),
        F.concat(stem, F.lit("_data.zip")).alias("file_name"),
        F.when(has_meta, F.concat(stem, F.lit("_meta.zip"))).alias("file_name_meta"),
    )
