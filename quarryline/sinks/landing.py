"""Incremental landing of period-partitioned Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quarryline.plans.sizing import small_side
from quarryline.session import pin
from quarryline.sinks.commitlog import commit_version, forget_versions, read_version, version_numbers
from quarryline.sinks.paths import exists, matching_paths, move_folder, remove_file, remove_folder, touch
from quarryline.sources.literal import literal_table

MARKER = "_SUCCESS"


def write_table(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


def write_periods(df: DataFrame, path: str, period: str) -> None:
    """One folder per period.  Only periods present in ``df`` are replaced.

    The rebalance hint lets adaptive execution join small periods' pieces and
    split a period that holds much of the data over several files.  Periods are
    written aside and moved in whole, so a folder that exists is a whole period;
    the completion marker of the table is absent while the job runs.
    """
    spark, spread = df.sparkSession, df.hint("rebalance", period)
    remove_file(spark, f"{path}/{MARKER}")
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(period).parquet(path)
    touch(spark, f"{path}/{MARKER}")


def _log(path: str) -> str:
    return f"{path.rstrip('/')}-log"


def _aside(path: str, number: int) -> str:
    return f"{path.rstrip('/')}-staging/{number:012d}"


def _last_version(spark: SparkSession, path: str) -> tuple[int, dict]:
    """Number and listing of the last committed landing; number 0 before the first."""
    numbers = version_numbers(spark, _log(path))
    return (numbers[-1], read_version(spark, _log(path), numbers[-1])) if numbers else (0, {"periods": [], "folders": []})


def landed_periods(spark: SparkSession, path: str, period: str) -> DataFrame:
    """Periods already landed: those of the last committed version, with and without
    rows, and the table's folders."""
    found = [p.rsplit("=", 1)[1] for p in matching_paths(spark, f"{path}/{period}=*")]
    noted = _last_version(spark, path)[1]["periods"]
    dates = literal_table(spark, [(p,) for p in sorted({*found, *noted})], f"{period} string")
    return dates.select(F.try_to_date(period).alias(period)).na.drop().distinct()


def missing_periods(wanted: DataFrame, landed: DataFrame, period: str) -> DataFrame:
    return wanted.select(period).na.drop().distinct().join(landed.select(period), period, "left_anti")


def outside_calendar(rows: DataFrame, wanted: DataFrame, period: str) -> DataFrame:
    """The rows that ``land`` refuses: without a period, or of one that is not wanted."""
    return rows.join(wanted.select(period), period, "left_anti")


def land(rows: DataFrame, wanted: DataFrame, path: str, period: str) -> DataFrame:
    """Write the rows of every wanted period not landed yet, as ONE job; returns the
    periods that were missing.

    A row outside the calendar fails the job (``outside_calendar`` lists such rows).
    A period without rows counts as landed too, so a run that has nothing to land
    scans nothing.

    The rows are written beside the table.  One small version file then says which
    periods are landed, with or without rows, and which folders belong in the table;
    only after it are folders moved and the marker set.  A run stopped before the
    version file has landed nothing; one stopped after it is finished by ``recover``,
    which the next run calls first.  One run lands into a table at a time.
    """
    spark = rows.sparkSession
    recover(spark, path)
    landed = landed_periods(spark, path, period)
    missing = pin(missing_periods(wanted, landed, period))
    if missing.isEmpty():
        return missing
    calendar = wanted.select(period).union(landed.select(period)).distinct()
    known = pin(calendar.join(missing.withColumn("_todo", F.lit(True)), period, "left").withColumnRenamed(period, "_period"))
    told = F.concat(F.lit("row outside the calendar: "), F.coalesce(F.col(period).cast("string"), F.lit("null")))
    todo = F.when(F.col("_period").isNull(), F.raise_error(told).cast("boolean")).otherwise(F.col("_todo"))
    dealt = rows.join(small_side(known), F.col(period) == F.col("_period"), "left").filter(todo)
    last, listing = _last_version(spark, path)
    aside = _aside(path, last + 1)
    dealt.drop("_period", "_todo").hint("rebalance", period).write.mode("overwrite").partitionBy(period).parquet(aside)
    new = [str(r[0]) for r in missing.collect()]  # a calendar, not data
    folders = [p.rsplit("/", 1)[1] for p in matching_paths(spark, f"{aside}/{period}=*")]
    commit_version(spark, _log(path), last + 1, {"periods": sorted({*listing["periods"], *new}), "folders": folders})
    recover(spark, path)
    return missing


def recover(spark: SparkSession, path: str) -> bool:
    """Finish the last committed landing; True if anything was left to do.  Every step
    may be repeated: a folder is in its place or still aside, and the marker comes last."""
    number, listing = _last_version(spark, path)
    aside = _aside(path, number)
    if not number or not exists(spark, aside):
        return False
    remove_file(spark, f"{path}/{MARKER}")
    for folder in listing["folders"]:
        if exists(spark, f"{aside}/{folder}"):
            move_folder(spark, f"{aside}/{folder}", f"{path}/{folder}")
    touch(spark, f"{path}/{MARKER}")
    remove_folder(spark, aside)
    forget_versions(spark, _log(path), 2)
    return True


def is_complete(spark: SparkSession, path: str) -> bool:
    """True when the writing job committed: its marker file exists."""
    return exists(spark, f"{path}/{MARKER}")


def read_complete(spark: SparkSession, path: str) -> DataFrame:
    """The table, refused while its writing job has not committed."""
    if not is_complete(spark, path):
        raise FileNotFoundError(f"{path} has no completion marker")
    return spark.read.parquet(path)
