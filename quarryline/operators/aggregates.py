"""Counts, shares, sums, bins and category order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def row_count(df: DataFrame, keys: Sequence[str | Column], name: str = "len") -> DataFrame:
    """Rows per group; a null key is a group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def row_count_by_category(df: DataFrame, period: str, categories: Sequence[str]) -> DataFrame:
    """Rows per (period, category value) for several category columns in ONE pass.

    Grouping sets keep the map-side combine: a task sends at most one row per
    distinct group, however many rows it read.
    """
    plain = df.select(period, *[F.col(c).cast("string").alias(c) for c in categories])
    sets = [[F.col(period), F.col(c)] for c in categories]
    grouped = plain.groupingSets(sets, period, *categories).agg(
        F.count(F.lit(1)).alias("len"), *[F.grouping(c).alias(f"_g_{c}") for c in categories]
    )
    which, value = F.lit(None), F.lit(None)
    for c in categories:
        chosen = F.col(f"_g_{c}") == 0
        which = F.when(chosen, F.lit(c)).otherwise(which)
        value = F.when(chosen, F.col(c)).otherwise(value)
    return grouped.select(period, which.alias("category"), value.alias("value"), "len")


def sum_or_zero(c: Column, dtype: str | None = None) -> Column:
    """Sum in which a group without values is 0; optionally back in its own type."""
    total = F.coalesce(F.sum(c), F.lit(0))
    return total if dtype is None else total.cast(dtype)


def share(df: DataFrame, predicates: Mapping[str, Column]) -> DataFrame:
    """Total, matching rows and share for several predicates in one scan."""
    outputs = [F.count(F.lit(1)).alias("n_total")]
    for name, predicate in predicates.items():
        matched = F.count_if(predicate)
        outputs += [
            matched.alias(f"n_{name}"),
            (matched / F.nullif(F.count(F.lit(1)), F.lit(0))).alias(f"share_{name}"),
        ]
    return df.agg(*outputs)


def extent(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))])


def equal_width_bins(df: DataFrame, outputs: Mapping[str, str], bins: int) -> DataFrame:
    """``column -> output``: the class 1..bins of each column between its minimum and
    maximum.  The maximum is in the last class, nulls stay null, a constant column
    is class 1.  All ends come from one aggregate."""
    ends = extent(df.select(*[F.col(c).cast("double").alias(c) for c in outputs]), list(outputs))

    def binned(column: str) -> Column:
        lo, hi = (ends.select(f"{end}_{column}").scalar() for end in ("min", "max"))
        v = F.col(column).cast("double")
        at = F.least(F.width_bucket(v, lo, hi, F.lit(bins)), F.lit(bins))
        return F.when(v.isNull(), F.lit(None)).when(lo == hi, F.lit(1)).otherwise(at).cast("int")

    return df.withColumns({output: binned(column) for column, output in outputs.items()})


def category_order(counts: DataFrame, facet: str, category: str, measure: str = "len") -> DataFrame:
    """Rank of each category by descending measure within its facet, ties by name.

    Input is an aggregated table: one row per value of a coded column.
    """
    window = Window.partitionBy(facet).orderBy(F.col(measure).desc_nulls_first(), F.col(category).asc())
    return counts.withColumn("rank", F.row_number().over(window))


def distinct_list(c: Column) -> Column:
    """Distinct non-null values of a group, sorted and comma-joined."""
    return F.array_join(F.array_sort(F.collect_set(c)), ",")
