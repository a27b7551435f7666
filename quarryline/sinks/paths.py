"""Existence checks on whatever file system a path belongs to."""

from __future__ import annotations

from pyspark.sql import SparkSession


def located(spark: SparkSession, path: str):
    """The path and the file system it belongs to."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching a glob, sorted; also finds the marker files scans leave out."""
    target, system = located(spark, pattern)
    found = system.globStatus(target)
    return sorted(s.getPath().toString() for s in found) if found else []


def exists(spark: SparkSession, path: str) -> bool:
    return bool(matching_paths(spark, path))


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty marker file, replacing an older one."""
    target, system = located(spark, path)
    system.create(target, True).close()


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder this library wrote, with its files."""
    target, system = located(spark, path)
    system.delete(target, True)


def move_folder(spark: SparkSession, path: str, target: str) -> None:
    """Put a folder this library wrote in the place of ``target``."""
    source, system = located(spark, path)
    final, _ = located(spark, target)
    system.mkdirs(final.getParent())
    system.delete(final, True)
    if not system.rename(source, final):
        raise OSError(f"{path} could not be moved to {target}")


def remove_file(spark: SparkSession, path: str) -> None:
    """Remove one marker file if it is there."""
    target, system = located(spark, path)
    system.delete(target, False)


def stamp_in_order(spark: SparkSession, paths: list[str]) -> None:
    """Give files modification times a second apart, in the order given; file streams
    take the oldest first."""
    now = spark._jvm.java.lang.System.currentTimeMillis()
    for place, path in enumerate(paths):
        target, system = located(spark, path)
        system.setTimes(target, now - 1000 * (len(paths) - place), -1)
