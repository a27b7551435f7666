"""Choices between physical strategies, always from a measured size.

Plain joins are left to the optimizer, which broadcasts a side only below
``spark.sql.autoBroadcastJoinThreshold`` of measured bytes.  The helpers here
serve the few places that must choose a plan shape themselves.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import AtomicType, BinaryType, StringType

# Bytes of a side, by the measure below, that every executor may be sent.
BROADCAST_BYTES = 16_000_000
# Bytes of a map that is written into the plan as a literal.
LITERAL_BYTES = 1_000_000


def row_bytes(df: DataFrame) -> Column:
    """About the bytes a row of ``df`` holds: 16 a column, and the length of text,
    of binary values and of the text form of nested ones."""
    total = F.lit(16 * len(df.columns)).cast("long")
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, StringType | BinaryType):
            total = total + F.coalesce(F.octet_length(value), F.lit(0))
        elif not isinstance(field.dataType, AtomicType):
            total = total + F.coalesce(F.octet_length(value.cast("string")), F.lit(0))
    return total


def small_side(pinned: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """A pinned table marked for broadcast if its bytes prove few, else unchanged (a
    shuffled join, where adaptive execution splits hot keys)."""
    held = pinned.agg(F.sum(row_bytes(pinned))).first()[0] or 0
    return F.broadcast(pinned) if held <= max_bytes else pinned


def together_small(sizes: Mapping[str, int], max_bytes: int = BROADCAST_BYTES) -> set[str]:
    """The sides, smallest first, whose bytes together stay within the limit: joins of
    one plan hold all their broadcast sides at once."""
    held, out = 0, set()
    for name, size in sorted(sizes.items(), key=lambda item: (item[1], item[0])):
        held += size
        if held > max_bytes:
            break
        out.add(name)
    return out
