"""File listings, member selection, JSON payloads, GeoJSON and Parquet."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quarryline.functions.text import split_head


def named(df: DataFrame, path: str = "path") -> DataFrame:
    """Adds ``name`` (last part of a path) and ``stem`` (the name without its extension)."""
    name = F.element_at(F.split(path, "/"), -1)
    return df.withColumns({"name": name, "stem": F.regexp_replace(name, r"\.[^.]*$", "")})


def listing(spark: SparkSession, path: str, name_glob: str = "*") -> DataFrame:
    """``path, modified, bytes, name, stem`` of files below a folder, contents unread."""
    files = spark.read.format("binaryFile").options(pathGlobFilter=name_glob, recursiveFileLookup=True)
    found = files.load(path).select(
        "path", F.col("modificationTime").alias("modified"), F.col("length").alias("bytes")
    )
    return named(found)


def keyed(files: DataFrame, separator: str = "-", exclude: Sequence[str] = ()) -> DataFrame:
    """Files with ``key``, the first part of the stem; listed stems left out."""
    kept = files.filter(~F.col("stem").isin(*exclude)) if exclude else files
    return kept.withColumn("key", split_head(F.col("stem"), separator))


def latest(files: DataFrame, by: str = "modified", keys: Sequence[str] = ()) -> DataFrame:
    """The newest path (per key); of equal times the greater path."""
    return files.groupBy(*keys).agg(F.max_by("path", F.struct(by, "path")).alias("path"), F.max(by).alias(by))


def is_member(name: Column, month: Column, suffix: str = "-street", extension: str = ".csv") -> Column:
    """Name starts with the month (YYYY-MM) and ends in ``suffix`` before the extension."""
    starts = name.startswith(F.date_format(month, "yyyy-MM"))
    return starts & split_head(name, extension).endswith(suffix)


def contains_member(name: Column, part: str, extension: str = ".csv") -> Column:
    return name.contains(part) & name.endswith(extension)


def payload_rows(df: DataFrame, body: str, field: str, row_type: str, keep: Sequence[str] = ()) -> DataFrame:
    """The array ``field`` of a JSON payload as rows of a fixed type."""
    parsed = F.from_json(F.col(body), f"struct<{field}:array<{row_type}>>")
    rows = df.select(*keep, F.explode(parsed[field]).alias("_row"))
    return rows.select(*keep, "_row.*")


SERVICE_ROW = "struct<name:string,type:string,url:string>"


# The same member once more in a feature's text: a feature that does not begin with it.
STRAY_FEATURE = r'"type"\s*:\s*"Feature"\s*[,}]'


def feature_border(spark: SparkSession, paths: str | Sequence[str]) -> str | None:
    """The text a feature begins with in the first file, blanks as written there; None
    where the file has no feature that begins with its type."""
    head = spark.read.option("lineSep", '"Feature"').text(paths).first()
    found = re.search(r'\{\s*"type"\s*:\s*$', head["value"]) if head else None
    return f'{found[0]}"Feature"' if found else None


def read_geojson(
    spark: SparkSession, paths: str | Sequence[str], properties: str, border: str | None = None, whole: bool = False
) -> DataFrame:
    """Features of FeatureCollection files (one document per file), chunks appended:
    ``id``, the declared properties, and ``geometry`` with its coordinates as text,
    since polygons and multi-polygons nest to different depths.

    Files are cut at the border with which features begin, by byte ranges, so one
    large file is read by many tasks and a task holds one feature at a time.  Inside
    a JSON text quotes are escaped, so the border cannot stand there.  All files must
    write it alike (``border`` names it; else the first file does): a feature that
    begins otherwise fails the job rather than being lost, and ``whole`` reads such
    files a document at a time.
    """
    feature = f"struct<type:string,id:string,geometry:struct<type:string,coordinates:string>,properties:struct<{properties}>>"
    border = None if whole else border or feature_border(spark, paths)
    if border is None:
        documents = spark.read.option("multiLine", True).schema(f"type string, features array<{feature}>").json(paths)
        return documents.select(F.explode("features").alias("f")).select("f.id", "f.properties.*", "f.geometry")
    pieces = spark.read.option("lineSep", border).text(paths)
    told = F.concat(F.lit("a feature does not begin with its type, or not as in the first file: "), F.substring("value", 1, 200))
    stray = F.when(F.col("value").rlike(STRAY_FEATURE), F.raise_error(told).cast("boolean")).otherwise(True)
    # What stands before the first feature of a file opens the collection; a feature goes on with its next member.
    opens = F.col("value").rlike(r"^\s*\{")
    parsed = pieces.filter(stray & ~opens).select(F.from_json(F.concat(F.lit(border), "value"), feature).alias("f"))
    return parsed.select("f.id", "f.properties.*", "f.geometry")


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Lazy scan of a file, folder or glob; period folders become a partition column."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df
