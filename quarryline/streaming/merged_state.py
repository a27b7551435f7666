"""Keyed state of a stream as a table of hash buckets with deltas.

A batch adds one delta: its own rows, merged, dealt by a hash of the key.  Nothing
is read for that, and a bucket no key of the batch falls in is not touched.  A
bucket with many deltas is rewritten as one base; the other buckets stay.  Each
batch commits a listing of the folders of every bucket, so a reader sees whole
batches only and a batch that is run again replaces itself.

``merge`` reduces rows to the state they stand for (the newest row, the last n).  It
must give the same whether applied to all rows or to merged parts of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from quarryline.sinks.commitlog import commit_version, forget_versions, read_version, version_numbers
from quarryline.sinks.paths import matching_paths, remove_folder

BUCKET = "_bucket"


@dataclass(frozen=True)
class MergedState:
    """State under ``path``; ``buckets`` may not change once the state has rows."""

    path: str
    keys: Sequence[str]
    merge: Callable[[DataFrame], DataFrame]
    buckets: int = 32
    compact_after: int = 8
    keep: int = 3

    def __post_init__(self) -> None:
        if self.keep < 2:  # a batch that is run again starts from the version before it
            raise ValueError("at least two versions have to be kept")

    def bucket(self) -> Column:
        return F.pmod(F.hash(*self.keys), F.lit(self.buckets))

    def apply(self, rows: DataFrame, batch_id: int, alive: Column | None = None) -> None:
        """Add the rows of a batch.  ``alive`` tells, when a bucket is rewritten, which
        rows of it are still wanted."""
        spark = rows.sparkSession
        listing, _ = self._listing(spark, batch_id)
        merged = self.merge(rows)
        for bucket, folder in self._write(merged, f"{batch_id:012d}-delta"):
            listing.setdefault(bucket, []).append(folder)
        full = {b: folders for b, folders in listing.items() if len(folders) > self.compact_after}
        if full:
            held = self.merge(self._stored(spark, full, merged.schema))
            held = held if alive is None else held.filter(alive)
            for bucket in full:
                listing.pop(bucket)
            for bucket, folder in self._write(held, f"{batch_id:012d}-base"):
                listing[bucket] = [folder]
        commit_version(spark, self._log, batch_id, {"buckets": listing, "schema": merged.schema.jsonValue()})
        self._clean(spark)

    def read(self, spark: SparkSession, before: int | None = None, buckets: Iterable[int] | None = None) -> DataFrame | None:
        """The state after the newest batch (or the newest one before batch ``before``), of
        all buckets or some; None while there is none."""
        listing, schema = self._listing(spark, before)
        if buckets is not None:
            listing = {str(b): listing[str(b)] for b in buckets if str(b) in listing}
        return self.merge(self._stored(spark, listing, schema)) if listing else None

    @property
    def _log(self) -> str:
        return f"{self.path}/versions"

    def _listing(self, spark: SparkSession, before: int | None) -> tuple[dict[str, list[str]], StructType | None]:
        numbers = [n for n in version_numbers(spark, self._log) if before is None or n < before]
        if not numbers:
            return {}, None
        version = read_version(spark, self._log, numbers[-1])
        return version["buckets"], StructType.fromJson(version["schema"])

    def _write(self, rows: DataFrame, folder: str) -> list[tuple[str, str]]:
        target = f"{self.path}/{folder}"
        dealt = rows.withColumn(BUCKET, self.bucket()).hint("rebalance", BUCKET)
        dealt.write.mode("overwrite").partitionBy(BUCKET).parquet(target)
        return [(p.rsplit("=", 1)[1], folder) for p in matching_paths(rows.sparkSession, f"{target}/{BUCKET}=*")]

    def _stored(self, spark: SparkSession, listing: dict[str, list[str]], schema: StructType) -> DataFrame:
        return spark.read.schema(schema).parquet(*[f"{self.path}/{f}/{BUCKET}={b}" for b, folders in listing.items() for f in folders])

    def _clean(self, spark: SparkSession) -> None:
        """Remove bucket folders that none of the versions kept lists."""
        listings = [read_version(spark, self._log, n)["buckets"] for n in forget_versions(spark, self._log, self.keep)]
        wanted = {(b, f) for listing in listings for b, folders in listing.items() for f in folders}
        for path in matching_paths(spark, f"{self.path}/*-*/{BUCKET}=*"):
            folder, bucket = path.rsplit("/", 2)[1:]
            if (bucket.rsplit("=", 1)[1], folder) not in wanted:
                remove_folder(spark, path)
