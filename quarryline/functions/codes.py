"""Recoding by maps written in code, closed domains and declaration order.

For lookups that are tables see ``operators.codebook``.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, functions as F

# A map is searched entry by entry, so a longer one is dealt into parts of about this many.
LITERAL_MAP_LIMIT = 64


def slug(label: str) -> str:
    """``Devon & Cornwall Police`` -> ``devon_and_cornwall_police``."""
    return label.lower().replace("&", "and").replace("-", "_").replace(" ", "_")


def literal_map(mapping: Mapping) -> Column:
    """The map as a constant.  Text maps travel as one JSON literal, which the
    optimizer folds into the map once, instead of two calls per entry."""
    if _is_text(mapping):
        return F.from_json(F.lit(json.dumps(dict(mapping))), "map<string,string>")
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def _is_text(mapping: Mapping) -> bool:
    return all(isinstance(x, str) for x in chain.from_iterable(mapping.items()))


def recode_lenient(c: Column, mapping: Mapping) -> Column:
    """Mapped label, or null for a code the map does not hold; maps of any length."""
    n_parts = -(-len(mapping) // LITERAL_MAP_LIMIT)
    if n_parts <= 1 or not _is_text(mapping):
        return F.try_element_at(literal_map(mapping), c)
    parts: list[dict[str, str]] = [{} for _ in range(n_parts)]
    for code, label in mapping.items():
        parts[zlib.crc32(code.encode()) % n_parts][code] = label
    dealt = F.from_json(F.lit(json.dumps(parts)), "array<map<string,string>>")
    part = F.crc32(c.cast("binary")) % n_parts
    return F.try_element_at(F.get(dealt, part.cast("int")), c)


def recode_strict(c: Column, mapping: Mapping, name: str = "value") -> Column:
    """Mapped label; a non-null code outside the map fails the job, null stays null."""
    label = recode_lenient(c, mapping)
    message = F.concat(F.lit(f"unmapped {name}: "), c.cast("string"))
    return F.when(c.isNull(), F.lit(None)).otherwise(F.coalesce(label, F.raise_error(message).cast("string")))


def unmapped(c: Column, mapping: Mapping) -> Column:
    """Predicate form of the strict rule, for a check that cannot be pruned away."""
    return c.isNotNull() & ~c.isin(*mapping)


def in_domain_strict(c: Column, domain: Sequence, name: str = "value") -> Column:
    """The value itself if null or declared, otherwise the job fails."""
    message = F.concat(F.lit(f"{name} outside its domain: "), c.cast("string"))
    return F.when(c.isNull() | c.isin(*domain), c).otherwise(F.raise_error(message).cast("string"))


def ordinal(c: Column, domain: Sequence) -> Column:
    """Position (from 1) in declaration order: the sort key of a coded column."""
    position = F.array_position(F.array(*[F.lit(x) for x in domain]), c)
    return F.nullif(position, F.lit(0)).cast("int")
