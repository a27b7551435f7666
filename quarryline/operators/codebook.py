"""Recoding driven by lookup tables: code-books, two-column lookups, overrides.

A lookup is a DataFrame ``(code, label)`` with one row per code.  Applying one
is a left equi-join, which the optimizer broadcasts only while the lookup is
measurably small; a hot code on the data side is then no shuffle at all, or is
split by the adaptive skew join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F

from quarryline.functions.codes import LITERAL_MAP_LIMIT, recode_lenient
from quarryline.functions.text import replace_first
from quarryline.plans.sizing import LITERAL_BYTES, row_bytes, together_small
from quarryline.session import pin
from quarryline.sources.literal import literal_table

MISSING_CODE = "-1"


# ---- building lookups ------------------------------------------------------


def one_label(rows: DataFrame, keys: Sequence[str], order: str | None = None) -> DataFrame:
    """One label for each code.  Of a repeated code the row last in ``order`` wins;
    without an order a code with two different labels fails the job."""
    if order is not None:
        return rows.groupBy(*keys).agg(F.max_by("label", F.struct(order, "label")).alias("label"))
    found = rows.groupBy(*keys).agg(F.min("label").alias("label"), F.max("label").alias("_other"))
    message = F.concat(F.lit("two labels for code "), F.col("code"))
    checked = F.when(F.col("label") == F.col("_other"), F.col("label")).otherwise(F.raise_error(message).cast("string"))
    return found.select(*keys, checked.alias("label"))


def lookup_from_columns(
    df: DataFrame, code: int = 0, label: int = 1, order: Column | None = None
) -> DataFrame:
    """Two columns chosen by position; rows with a null dropped; repeated codes as in ``one_label``."""
    code_c, label_c = df.columns[code], df.columns[label]
    pairs = df.select(
        F.col(code_c).cast("string").alias("code"),
        F.col(label_c).cast("string").alias("label"),
        *([] if order is None else [order.alias("_at")]),
    ).na.drop(subset=["code", "label"])
    return one_label(pairs, ["code"], None if order is None else "_at")


def literal_lookup(spark: SparkSession, mapping: Mapping[str, str]) -> DataFrame:
    return literal_table(spark, list(mapping.items()), "code string, label string")


def override(base: DataFrame, extra: DataFrame) -> DataFrame:
    """Union of two lookups; on a shared code the extra one's label wins."""
    ranked = base.withColumn("_p", F.lit(0)).unionByName(extra.withColumn("_p", F.lit(1)))
    return ranked.groupBy("code").agg(F.max_by("label", "_p").alias("label"))


# ---- applying lookups ------------------------------------------------------


@dataclass(frozen=True)
class Recode:
    """How one column is recoded: codes missing from the lookup become ``fallback``
    when given, else fail the job when ``strict``, else become null; a null code
    becomes ``null_label``."""

    column: str
    output: str
    strict: bool = False
    fallback: str | None = None
    null_label: str | None = None

    def label(self, found: Column) -> Column:
        code = F.col(self.column)
        if self.fallback is not None:
            found = F.coalesce(found, F.lit(self.fallback))
        elif self.strict:
            message = F.concat(F.lit(f"unmapped {self.column}: "), code.cast("string"))
            found = F.coalesce(found, F.raise_error(message).cast("string"))
        return F.when(code.isNull(), F.lit(self.null_label)).otherwise(found)


def with_labels(
    df: DataFrame, recodes: Sequence[tuple[Recode, DataFrame | Mapping[str, str]]]
) -> tuple[DataFrame, dict[str, Column]]:
    """The frame joined to every lookup table its recodes need, and the label
    expressions by output name.  Mappings become literal maps and need no join;
    recodes of one column by one table share a join."""
    df, found = _with_found(df, recodes)
    return df, {recode.output: recode.label(label) for recode, label in found}


def _with_found(
    df: DataFrame, recodes: Sequence[tuple[Recode, DataFrame | Mapping[str, str]]]
) -> tuple[DataFrame, list[tuple[Recode, Column]]]:
    """The frame with its lookups, and what each recode finds there (null where nothing)."""
    sides: dict[tuple[str, int], str] = {}
    out: list[tuple[Recode, Column]] = []
    for recode, lookup in recodes:
        if isinstance(lookup, Mapping):
            found = recode_lenient(F.col(recode.column).cast("string"), lookup)
        else:
            at = (recode.column, id(lookup))
            if at not in sides:
                sides[at] = f"_label{len(sides)}"
                code = f"_code{len(sides)}"
                side = lookup.select(F.col("code").alias(code), F.col("label").alias(sides[at]))
                df = df.join(side, F.col(recode.column).cast("string") == F.col(code), "left")
            found = F.col(sides[at])
        out.append((recode, found))
    return df, out


class DomainWatch:
    """Counts values outside their domains while a frame is computed for another purpose.

    The counters are part of the plan (``DataFrame.observe``), so they see every row
    and stay when the labels that would prove a code are not selected.  They are read
    after the action; before it ``counts`` would wait for one.
    """

    def __init__(self) -> None:
        self._observation = Observation()
        self._columns: list[str] = []

    def over(self, df: DataFrame, unknown: Mapping[str, Column]) -> DataFrame:
        """The frame itself, watched; ``unknown`` tells for each column which rows are outside."""
        self._columns = list(unknown)
        counters = []
        for i, (column, outside) in enumerate(unknown.items()):
            outside = F.coalesce(outside, F.lit(False))
            counters += [F.count_if(outside).alias(f"n{i}"), F.min(F.when(outside, F.col(column).cast("string"))).alias(f"e{i}")]
        return df.observe(self._observation, *counters)

    def counts(self) -> list[tuple[str, int, str | None]]:
        """(column, rows outside, the least such value) of the last action."""
        seen = self._observation.get
        return [(c, seen.get(f"n{i}") or 0, seen.get(f"e{i}")) for i, c in enumerate(self._columns)]

    def require_none(self) -> None:
        bad = [f"{c}: {n} rows, such as {example!r}" for c, n, example in self.counts() if n]
        if bad:
            raise ValueError(f"codes outside their domain: {'; '.join(bad)}")


def watched_labels(
    df: DataFrame,
    recodes: Sequence[tuple[Recode, DataFrame | Mapping[str, str]]],
    watch: DomainWatch,
    also: Mapping[str, Column] | None = None,
) -> tuple[DataFrame, dict[str, Column]]:
    """As ``with_labels``; the codes of strict recodes (and the columns that ``also``
    judges) are counted by ``watch`` and, so that all of them are seen, an unmapped code
    gives a null label instead of failing."""
    df, found = _with_found(df, recodes)
    unknown = dict(also or {})
    for recode, label in found:
        if recode.strict and recode.fallback is None:
            outside = F.col(recode.column).isNotNull() & label.isNull()
            unknown[recode.column] = unknown[recode.column] | outside if recode.column in unknown else outside
    df = watch.over(df, unknown)
    return df, {recode.output: replace(recode, strict=False).label(label) for recode, label in found}


def apply_lookup(
    df: DataFrame, column: str, lookup: DataFrame | Mapping[str, str], output: str, **rules
) -> DataFrame:
    """Adds (or replaces) ``output``: the label of ``column``'s code; ``rules`` as in ``Recode``."""
    joined, labels = with_labels(df, [(Recode(column, output, **rules), lookup)])
    kept = [labels[output].alias(c) if c == output else F.col(f"`{c}`") for c in df.columns]
    return joined.select(*kept, *([] if output in df.columns else [labels[output].alias(output)]))


def lookup_entry(name: str, code: str, label: str, priority: int, order: str | None = None) -> str:
    """SQL of one row of a many-lookup table: a later priority, then a later row, wins."""
    quoted = name.replace("'", "\\'")
    block, row = (f"{order}.block", f"{order}.row") if order else ("0", "0")
    return (
        f"named_struct('map', '{quoted}', 'code', CAST(`{code}` AS STRING), 'label', CAST(`{label}` AS STRING), "
        f"'at', named_struct('priority', {priority}, 'block', CAST({block} AS BIGINT), 'row', CAST({row} AS BIGINT)))"
    )


def resolve_lookups(rows: DataFrame) -> dict[str, DataFrame | dict[str, str]]:
    """Many lookups (rows of ``lookup_entry``) at once, each as a literal map if
    short, in rows and in bytes, else as a table; the smallest tables are marked for
    broadcast, as many as are few bytes together.

    One job reads and de-duplicates them all into a pinned table.
    """
    usable = rows.na.drop(subset=["code", "label"])
    long = pin(usable.groupBy("map", "code").agg(F.max_by("label", F.struct("at", "label")).alias("label")))
    sizes = _sizes(long, "map")
    short = [name for name, size in sizes.items() if _literal(size)]
    out: dict[str, DataFrame | dict[str, str]] = {name: {} for name in short}
    for row in long.filter(F.col("map").isin(*short)).collect() if short else []:
        out[row["map"]][row["code"]] = row["label"]
    joined = {name: held for name, (_, held) in sizes.items() if name not in out}
    sent = together_small(joined)
    for name in joined:
        table = long.filter(F.col("map") == name).select("code", "label")
        out[name] = F.broadcast(table) if name in sent else table
    return out


def _sizes(labels: DataFrame, name: str) -> dict[str, tuple[int, int]]:
    """Rows and bytes of each lookup in a table of many: a row for each lookup."""
    sizes = labels.groupBy(name).agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes(labels.select("code", "label"))).alias("held"))
    return {r[name]: (r["n"], r["held"]) for r in sizes.collect()}


def _literal(size: tuple[int, int]) -> bool:
    return size[0] <= LITERAL_MAP_LIMIT and size[1] <= LITERAL_BYTES


def unmapped_codes(df: DataFrame, column: str, lookup: DataFrame) -> DataFrame:
    """Distinct non-null codes the lookup does not hold."""
    codes = df.select(F.col(column).cast("string").alias("code")).na.drop()
    return codes.join(lookup.select("code"), "code", "left_anti").distinct()


def observed_domain(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values: the domain a column declares by itself."""
    return df.select(column).na.drop().distinct()


def check_domain(df: DataFrame, column: str, lookup: DataFrame) -> DataFrame:
    """The frame itself, failing at run time on a value outside the lookup's codes."""
    side = lookup.select(F.col("code").alias("_code"))
    joined = df.join(side, F.col(column).cast("string") == F.col("_code"), "left")
    message = F.concat(F.lit(f"{column} outside its domain: "), F.col(column).cast("string"))
    bad = F.col(column).isNotNull() & F.col("_code").isNull()
    checked = F.when(bad, F.raise_error(message).cast("string")).otherwise(F.col(column))
    return joined.withColumn(column, checked).drop("_code")


# ---- code-book of many fields ---------------------------------------------


def read_codebook(df: DataFrame, order: Column | None = None) -> DataFrame:
    """Standard shape ``(table, field, code, label)`` of a published code-book,
    with the two names that differ between book and data put right; ``at`` holds
    the rows' order if one is given."""
    named = df.withColumnsRenamed({c: c.strip().lower() for c in df.columns})
    return named.select(
        replace_first(F.col("table"), "accident", "collision").alias("table"),
        replace_first(
            F.col("field name"), "enhanced_collision_severity", "enhanced_severity_collision"
        ).alias("field"),
        F.col("code/format").cast("string").alias("code"),
        F.col("label").cast("string").alias("label"),
        *([] if order is None else [order.alias("at")]),
    )


class CodeBook:
    """The fields of one code-book that a table's coded columns need.

    The book is read once and pinned with one label for each code: of a repeated
    code the row last in the book's column ``at`` wins; without that column two
    labels fail the job.  Short fields are written as literal maps (no join),
    longer ones are joined; the labels are the same either way.
    """

    def __init__(self, book: DataFrame, drop_missing_code: bool = False):
        usable = book.filter(F.col("code").isNotNull() & F.col("label").isNotNull())
        self.book = usable.filter(F.col("code") != MISSING_CODE) if drop_missing_code else usable
        self._labels = pin(one_label(self.book, ["field", "code"], "at" if "at" in book.columns else None))
        sizes = _sizes(self._labels, "field")
        self.fields = set(sizes)
        short = [field for field, size in sizes.items() if _literal(size)]
        self._maps: dict[str, dict[str, str]] = {}
        for row in self._labels.filter(F.col("field").isin(*short)).collect() if short else []:
            self._maps.setdefault(row.field, {})[row.code] = row.label

    def literal(self, field: str) -> dict[str, str] | None:
        """The field's map if it is short enough to write as a literal."""
        return self._maps.get(field)

    def lookup(self, field: str) -> DataFrame:
        return self._labels.filter(F.col("field") == field).select("code", "label")

    def domain(self, field: str) -> DataFrame:
        """``label, position``: labels in the sorted order a coded column compares by."""
        labels = self.lookup(field).select("label").distinct()
        return labels.withColumn("position", F.row_number().over(Window.orderBy("label")))
