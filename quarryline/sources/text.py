"""CSV readers.  Every column arrives as text; a quoted empty field is an empty
string and a missing field is null, which Spark's defaults would merge."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from quarryline.functions import casts

# A null marker no file contains, so that only a missing field reads as null.
_CSV = {"nullValue": "\u0000", "emptyValue": "", "mode": "FAILFAST", "escape": '"'}


def text_schema(names: Sequence[str]) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str],
    *,
    header: bool = True,
    name_glob: str | None = None,
    **options,
) -> DataFrame:
    """All-text scan of files, folders or globs; columns by position."""
    reader = spark.read.options(**{**_CSV, "header": header, "enforceSchema": True, **options})
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    return reader.schema(text_schema(columns)).csv(paths)


def read_csv_typed(
    spark: SparkSession, paths: str | Sequence[str], types: Mapping[str, str], **options
) -> DataFrame:
    """Text scan, then a strict cast of every column to its declared type."""
    raw = read_csv(spark, paths, list(types), **options)
    return raw.select(*[casts.strict(F.col(c), t).alias(c) for c, t in types.items()])


def header_of(spark: SparkSession, path: str, row: int = 0) -> list[str]:
    """Column names: the ``row``-th line of a (small) file, as written; a blank field is
    named by its position, ``column_2`` for the second."""
    lines = spark.read.options(**{**_CSV, "header": False}).csv(path).limit(row + 1).collect()
    return [v or f"column_{i}" for i, v in enumerate(lines[row], 1)]


def read_csv_sidecar(spark: SparkSession, paths, header_path: str, **options) -> DataFrame:
    """Headerless files whose names stand in the first data row (the one under the
    header line) of a sidecar file."""
    return read_csv(spark, paths, header_of(spark, header_path, row=1), header=False, **options)


def file_order() -> Column:
    """Row order within one file: split start, then position in the split."""
    return F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))


def profile_types(spark: SparkSession, paths, sampling_ratio: float = 1.0) -> dict[str, str]:
    """Types Spark would infer, by default from all rows: a help for writing a declaration."""
    reader = spark.read.options(header=True, inferSchema=True, samplingRatio=sampling_ratio)
    return dict(reader.csv(paths).dtypes)
