"""The table loader: declared types in, cleaned table out.

Stages run in a fixed order: every declared column is cleaned from the same
input frame, then named column expressions, then renames, then frame
functions.  Columns without a declared type pass through unchanged.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from quarryline.functions import casts
from quarryline.functions.codes import recode_lenient
from quarryline.operators.codebook import CodeBook, apply_lookup

# Kinds a schema may name besides Spark's own number types.
KINDS = ("string", "categorical", "boolean", "coded", "date", "time")
NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")


def clean_table(
    df: DataFrame,
    schema: Mapping[str, str] | None = None,
    *,
    formats: Mapping[str, str] | None = None,
    codebook: CodeBook | None = None,
    column_operations: Mapping[str, Column] | None = None,
    renames: Mapping[str, str] | None = None,
    frame_operations: Sequence[Callable[[DataFrame], DataFrame]] = (),
) -> DataFrame:
    """Clean an all-text frame by a declared ``column -> kind`` schema."""
    if schema:
        df = _apply_schema(df, schema, formats or {}, codebook)
    if column_operations:
        df = parallel_columns(df, column_operations)
    if renames:
        df = df.withColumnsRenamed(dict(renames))
    return apply_in_order(df, frame_operations)


def _apply_schema(df, schema, formats, codebook) -> DataFrame:
    literals, lookups = {}, []
    for name, kind in schema.items():
        c = F.col(name)
        if kind in ("string", "categorical"):
            literals[name] = casts.clean_string(c)
        elif kind == "boolean":
            literals[name] = casts.clean_boolean(c)
        elif kind == "date":
            literals[name] = casts.clean_date(c, formats[name])
        elif kind == "time":
            literals[name] = casts.clean_time(c, formats[name])
        elif kind in NUMBERS:
            literals[name] = casts.lenient(c, kind)
        elif kind == "coded":
            if codebook is None or name not in codebook.fields:
                literals[name] = c.cast("string")  # the observed values are the domain
            elif (mapping := codebook.literal(name)) is not None:
                literals[name] = recode_lenient(c.cast("string"), mapping)
            else:
                lookups.append(name)
        else:
            raise ValueError(f"unknown kind {kind!r} for column {name!r}")
    df = df.withColumns(literals)
    for name in lookups:
        df = apply_lookup(df, name, codebook.lookup(name), name)
    return df


def parallel_columns(df: DataFrame, operations: Mapping[str, Column]) -> DataFrame:
    """Add or replace columns at once: every expression sees the input frame."""
    bad = [name for name, op in operations.items() if not isinstance(op, Column)]
    if bad:
        raise ValueError(f"column operations must be Columns: {bad}")
    return df.withColumns(dict(operations))


def apply_in_order(df: DataFrame, operations: Sequence[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    for operation in operations:
        df = df.transform(operation)
    return df


def null_census(df: DataFrame) -> DataFrame:
    """One row: the number of nulls in every column, in one pass."""
    return df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
