"""String helpers whose rules differ from the nearest Spark built-in."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F


def trim_spaces(c: Column) -> Column:
    """Strip the space character only, both ends (tabs and newlines stay)."""
    return F.trim(c, F.lit(" "))


def replace_first(c: Column, old: str, new: str) -> Column:
    """Replace the first occurrence only; Spark's ``replace`` replaces all."""
    at = F.instr(c, old)
    return F.when(at > 0, F.overlay(c, F.lit(new), at, F.lit(len(old)))).otherwise(c)


def split_head(c: Column, separator: str) -> Column:
    return F.split_part(c, F.lit(separator), F.lit(1))


def zero_pad(c: Column, width: int | Column) -> Column:
    """Pad with zeros on the left; longer text is never cut, unlike ``lpad``."""
    text = c.cast("string")
    target = F.lit(width) if isinstance(width, int) else width
    return F.lpad(text, F.greatest(target, F.length(text)), F.lit("0"))


def concat_all(separator: str, *parts: Column) -> Column:
    """Join with a separator; null if any part is null, unlike ``concat_ws``."""
    joined = [parts[0]]
    for part in parts[1:]:
        joined += [F.lit(separator), part]
    return F.concat(*joined)


def harvest_attribute(html: Column, element: str, where: tuple[str, str], attribute: str) -> Column:
    """Distinct upper-cased ``attribute`` values of matching elements, sorted and comma-joined.

    ``where`` is the (attribute, value) an element must carry.  Each whole tag
    is taken first, so attribute order does not matter.
    """
    tags = F.regexp_extract_all(html, F.lit(rf"(?i)<{element}\b([^>]*)>"), F.lit(1))
    name, wanted = where
    matching = F.filter(tags, lambda t: F.concat(F.lit(" "), t).rlike(_attribute_pattern(name, wanted)))
    return _join_values(matching, attribute)


def harvest_any(html: Column, element: str, attribute: str) -> Column:
    """As ``harvest_attribute`` for every ``element`` that has the attribute."""
    tags = F.regexp_extract_all(html, F.lit(rf"(?i)<{element}\b([^>]*)>"), F.lit(1))
    return _join_values(tags, attribute)


def _attribute_pattern(name: str, value: str) -> str:
    exact = f"(?-i:{re.escape(value)})"
    return rf"""(?i)\s{name}\s*=\s*(?:"{exact}"|'{exact}'|{exact}(?=[\s/]|$))"""


def _join_values(tags: Column, attribute: str) -> Column:
    pattern = rf"""(?i)\s{attribute}\s*=\s*(?:"([^"]*)"|'([^']*)')"""

    def value(tag: Column) -> Column:
        spaced = F.concat(F.lit(" "), tag)
        return F.upper(F.concat(F.regexp_extract(spaced, pattern, 1), F.regexp_extract(spaced, pattern, 2)))

    present = F.filter(tags, lambda t: F.concat(F.lit(" "), t).rlike(pattern))
    return F.array_join(F.array_sort(F.array_distinct(F.transform(present, value))), ",")


def header_names(columns: list[str], style: str) -> dict[str, str]:
    """Old name -> new name for ``title``, ``snake`` or ``spaces``; no change otherwise."""
    if style == "title":
        return {c: c.replace("_", " ").title() for c in columns}
    if style == "snake":
        return {c: c.lower().replace(" ", "_") for c in columns}
    if style == "spaces":
        return {c: c.replace("_", " ") for c in columns}
    return {}
