"""Checks over manifests, payloads and landed data; each lists what is wrong."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

STATUS_OKAY = 200


def bad_status(manifest: DataFrame, status: str, key: str, url: str) -> DataFrame:
    """Responses other than 200, also those without a status, with a message naming key and url."""
    told = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in (key, url, status)]
    message = F.concat(F.lit("bad response for "), told[0], F.lit(" at "), told[1], F.lit(": "), told[2])
    return manifest.filter(~F.col(status).eqNullSafe(STATUS_OKAY)).select(key, url, status, message.alias("message"))


def payload_flags(body: Column) -> dict[str, Column]:
    """``truncated`` and ``failed`` flags of a JSON payload."""
    cut = F.get_json_object(body, "$.properties.exceededTransferLimit")
    return {
        "truncated": F.coalesce(cut == "true", F.lit(False)),
        "failed": F.get_json_object(body, "$.error").isNotNull(),
    }


def payload_problems(df: DataFrame, body: str, keep: Sequence[str]) -> DataFrame:
    flagged = df.select(*keep, *[c.alias(n) for n, c in payload_flags(F.col(body)).items()])
    return flagged.filter("truncated or failed")


def chunk_gaps(manifest: DataFrame, ids: DataFrame, id_column: str, size: int) -> DataFrame:
    """Chunks that lack a declared id or hold one that is not declared.

    ``n_landed`` counts the distinct ids inside a chunk's range, ``n_stray`` those
    outside it; a chunk that nobody declared has ``n_declared`` 0 and only strays.
    """
    landed = ids.select(F.floor((F.col(id_column) - 1) / size).cast("bigint").alias("chunk"), F.col(id_column).alias("_id"))
    joined = manifest.join(landed.na.drop().distinct(), "chunk", "full")
    inside = F.coalesce(F.col("_id").between(F.col("id_start"), F.col("id_end")), F.lit(False))
    declared = [c for c in manifest.columns if c != "chunk"]
    counted = joined.groupBy("chunk", *declared).agg(
        F.count_if(inside).alias("n_landed"), F.count_if(F.col("_id").isNotNull() & ~inside).alias("n_stray")
    )
    n_declared = F.coalesce(F.col("id_end") - F.col("id_start") + 1, F.lit(0)).cast("bigint")
    return counted.withColumn("n_declared", n_declared).filter("n_landed <> n_declared or n_stray > 0")


def exactly_one(df: DataFrame, keys: Sequence[str], name: str, wanted: Column | None = None) -> DataFrame:
    """The single ``name`` of each group that ``wanted`` holds for; a group with none or
    several fails the job.  Pass all rows with the predicate: a group that a filter has
    emptied could not be seen."""
    hit = F.col(name) if wanted is None else F.when(wanted, F.col(name))
    found = df.groupBy(*keys).agg(F.count(hit).alias("_n"), F.min(hit).alias(name))
    message = F.concat(F.lit(f"expected exactly one {name}, found "), F.col("_n").cast("string"))
    checked = F.when(F.col("_n") == 1, F.col(name)).otherwise(F.raise_error(message).cast("string"))
    return found.select(*keys, checked.alias(name))


def match_counts(df: DataFrame, keys: Sequence[str], name: str, wanted: Column | None = None) -> DataFrame:
    """Groups that ``exactly_one`` would refuse, with their number of matches."""
    hit = F.col(name) if wanted is None else F.when(wanted, F.col(name))
    return df.groupBy(*keys).agg(F.count(hit).alias("n_matches")).filter("n_matches <> 1")


def digest_state(df: DataFrame, content: str, expected: str) -> DataFrame:
    """``ok``, ``mismatch`` or ``unverified`` (no expected digest) by MD5 of the content."""
    actual = F.md5(F.col(content).cast("binary"))
    state = (
        F.when(F.col(expected).isNull(), "unverified").when(F.col(expected) == actual, "ok").otherwise("mismatch")
    )
    return df.withColumns({"digest": actual, "state": state})


def require_none(problems: DataFrame, what: str, show: int = 5) -> None:
    """Raise if a check listed anything; reads at most ``show`` rows."""
    rows = problems.limit(show).collect()
    if rows:
        raise ValueError(f"{what}: {[r.asDict() for r in rows]}")
