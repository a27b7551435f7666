"""Session settings and the shared folder used for pinned and scratch tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from quarryline.sinks.paths import remove_folder

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Folders of the open ``scratch_scope`` blocks, the innermost last.
_SCOPES: list[str] = []


def local_session(app: str, cores: int | str = "*", **conf: str) -> SparkSession:
    """A single-machine session for tests and timing runs."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    ``spark.checkpoint.dir`` decides.  Only a local master without that
    setting gets a temporary folder; a cluster without it is an error, since
    a folder on one machine would be lost with that machine.
    """
    if _SCOPES:
        return _SCOPES[-1]
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if current:
        return named or current.rsplit("/", 1)[0]
    if named is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="quarryline-")
    context.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/scratch/{label}-{uuid.uuid4().hex}"


def pin(df: DataFrame) -> DataFrame:
    """Materialise a small intermediate reliably, so every reader of it sees the
    same rows even when an executor is lost and its stage runs again."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[str]:
    """Removes at its end, also after an error, all that was pinned or written to
    scratch paths within it.

    Write or collect results inside: a frame carried out of the block may read
    files that are gone.  What was pinned before the block stays.  Blocks may be
    nested, but the checkpoint folder belongs to the application, so blocks in
    several threads at a time aren't supported.  Only the block's own new
    folder, below the shared one, is removed.
    """
    context = spark.sparkContext
    outer = shared_folder(spark)
    checkpoints = context.getCheckpointDir().rsplit("/", 1)[0]
    folder = f"{outer}/runs/{uuid.uuid4().hex}"
    context.setCheckpointDir(folder)
    _SCOPES.append(folder)
    try:
        yield folder
    finally:
        _SCOPES.remove(folder)
        context.setCheckpointDir(checkpoints)
        remove_folder(spark, folder)
