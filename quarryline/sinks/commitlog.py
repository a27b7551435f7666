"""Numbered versions of a table's listing, each visible at once or not at all.

A version is one small JSON file.  It is written aside and moved to its name, so a
reader finds a whole version or the one before; data files that no version lists
are left-overs of a stopped job and are read by nobody.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from quarryline.sinks.paths import located, matching_paths, remove_file


def version_numbers(spark: SparkSession, log: str) -> list[int]:
    return sorted(int(p.rsplit("/", 1)[1].removesuffix(".json")) for p in matching_paths(spark, f"{log}/[0-9]*.json"))


def read_version(spark: SparkSession, log: str, number: int):
    target, system = located(spark, f"{log}/{number:012d}.json")
    stream = system.open(target)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def commit_version(spark: SparkSession, log: str, number: int, listing) -> None:
    """Make ``listing`` version ``number``; a version committed before under it is replaced."""
    aside, system = located(spark, f"{log}/.{number:012d}.json.new")
    final, _ = located(spark, f"{log}/{number:012d}.json")
    stream = system.create(aside, True)
    try:
        stream.write(bytearray(json.dumps(listing, sort_keys=True).encode()))
    finally:
        stream.close()
    if system.exists(final):
        system.delete(final, False)
    if not system.rename(aside, final):
        raise OSError(f"version {number} of {log} could not be moved to its name")


def forget_versions(spark: SparkSession, log: str, keep: int) -> list[int]:
    """Remove all but the last ``keep`` versions; returns those that stay."""
    numbers = version_numbers(spark, log)
    for number in numbers[:-keep]:
        remove_file(spark, f"{log}/{number:012d}.json")
    return numbers[-keep:]
