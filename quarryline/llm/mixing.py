"""Mixing sources to target weights by Pareto order sampling.

Each source has a target in words.  The ratio of the target to the source's size
gives every document whole copies for certain, and an inclusion probability for
one copy more.  For that copy documents are ranked by random odds divided by
inclusion odds, and taken in that order until the source's target is met.  The
random number follows from the id, so a rerun takes the same documents.

No source is ordered in one task: sizes are summed by a coarse cut of the rank,
the cut in which the target is met is cut again, and only the documents of one
fine cut (a share of one in STEPS squared) are ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarryline.session import pin

SOURCE_WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_COPIES = 2
STEPS = 4096
WORD = r"[^\x20\x09-\x0D]+"
_HEX_DIGITS = 13  # 52 bits, which a double holds exactly


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_number(key: Column, seed: int) -> Column:
    """Uniform in (0, 1), the same for the same key."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))))
    return (F.conv(F.substring(digest, 1, _HEX_DIGITS), 16, 10).cast("double") + 0.5) / float(16**_HEX_DIGITS)


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) of (source, size) rows.

    Sources in code-point order, null last, weigh SOURCE_WEIGHTS in turn.  What a
    target would have above MOST_COPIES times its source's size is shared again
    by weight.  With the sources ordered by size to weight, those that stop at
    their limit come first, so running sums give the final share directly.
    """
    weights = F.array(*[F.lit(w) for w in SOURCE_WEIGHTS])
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    per = per.withColumn("weight", weights[(F.row_number().over(by_name) - 1) % len(SOURCE_WEIGHTS)])
    per = per.withColumn("most", MOST_COPIES * F.col("source_size")).withColumn("turn", F.col("most") / F.col("weight"))
    order = Window.orderBy("turn", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    level = (
        SHARE * F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum("most").over(before), F.lit(0))
    ) / F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    per = per.withColumn("level", level)
    final = F.min(F.when(F.col("level") <= F.col("turn"), F.struct("turn", "level"))).over(Window.partitionBy())["level"]
    return per.withColumn("final", final).select(
        "source",
        "source_size",
        F.coalesce(F.least(F.col("final") * F.col("weight"), F.col("most").cast("double")), F.col("most").cast("double")).alias("target"),
    )


def _plan(per: DataFrame) -> DataFrame:
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(ratio + 1e-12)
    return per.withColumn("whole", whole).withColumn("inclusion", F.greatest(ratio - whole, F.lit(0.0)))


def _rank(odds: Column, inclusion: Column) -> Column:
    """Random odds over inclusion odds, drawn into (0, 1) without a change of order."""
    ratio = (odds / (1 - odds)) * ((1 - inclusion) / inclusion)
    return F.when(inclusion > 0, ratio / (1 + ratio))


def _same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def _crossed(sums: DataFrame, start: Column) -> DataFrame:
    """The first step at which the running sum reaches the wanted words, and the sum before it."""
    upto = Window.partitionBy("source").orderBy("step")
    run = sums.withColumn("reached", start + F.sum("words").over(upto))
    run = run.withColumn("before", F.col("reached") - F.col("words")).where(F.col("reached") >= F.col("wanted"))
    first = run.groupBy("source").agg(F.min(F.struct("step", "before", "wanted")).alias("x"))
    return first.select("source", "x.step", "x.before", "x.wanted")


def cutoffs(sizes: DataFrame, per: DataFrame, seed: int) -> DataFrame:
    """Plan rows with ``last``: the greatest rank that is taken in each source (null: none).

    ``sizes`` has (id, source, size).  Documents of equal rank, which are rows that
    share an id, are taken or left together; the cut that ends nearer to the target is chosen.
    """
    plan = pin(_plan(per))
    ranked = sizes.alias("d").join(plan.alias("p"), _same(F.col("d.source"), F.col("p.source")))
    ranked = ranked.select(
        "d.source", "size", (F.col("inclusion") * F.col("source_size")).alias("wanted"),
        _rank(random_number(F.col("id"), seed), F.col("inclusion")).alias("rank"),
    ).where("rank is not null")
    ranked = ranked.withColumn("coarse", F.floor(F.col("rank") * STEPS))
    ranked = ranked.withColumn("fine", F.floor((F.col("rank") * STEPS - F.col("coarse")) * STEPS))

    coarse = ranked.groupBy("source", F.col("coarse").alias("step"), "wanted").agg(F.sum("size").alias("words"))
    at = _crossed(coarse, F.lit(0)).select("source", F.col("step").alias("coarse_at"), F.col("before").alias("before_coarse"))
    inner = ranked.alias("r").join(at.alias("a"), _same(F.col("r.source"), F.col("a.source")) & (F.col("coarse") == F.col("coarse_at")))
    inner = inner.select("r.source", "size", "wanted", "rank", "fine", "before_coarse")

    fine = inner.groupBy("source", F.col("fine").alias("step"), "wanted", "before_coarse").agg(F.sum("size").alias("words"))
    at = _crossed(fine, F.col("before_coarse")).select("source", F.col("step").alias("fine_at"), F.col("before").alias("before_fine"))
    last = inner.alias("r").join(at.alias("a"), _same(F.col("r.source"), F.col("a.source")) & (F.col("fine") == F.col("fine_at")))
    last = last.groupBy("r.source", "rank", "wanted", "before_fine").agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("source").orderBy("rank")
    last = last.withColumn("reached", F.col("before_fine") + F.sum("words").over(upto))
    last = last.withColumn("before", F.col("reached") - F.col("words")).where("before < wanted")
    nearer = (F.col("reached") - F.col("wanted")) <= (F.col("wanted") - F.col("before"))
    edge = last.groupBy("source").agg(F.max(F.struct("rank", nearer.alias("taken"))).alias("x"))
    edge = edge.select("source", F.col("x.rank").alias("last"), F.col("x.taken").alias("last_taken"))
    return plan.alias("p").join(edge.alias("e"), _same(F.col("p.source"), F.col("e.source")), "left").select("p.*", "last", "last_taken")


def mix_copies(sizes: DataFrame, seed: int = 0) -> DataFrame:
    """(id, source, size, source_size, target, copies) for (id, source, size) rows.

    A null source is a source of its own.  Documents without words follow their
    source's ratio and take no words.  Null ids share one random number, as rows
    with equal ids do.  No rows give no rows.
    """
    sizes = pin(sizes)
    cut = pin(cutoffs(sizes, targets(sizes), seed))
    joined = sizes.alias("d").join(cut.alias("p"), _same(F.col("d.source"), F.col("p.source")))
    rank = _rank(random_number(F.col("id"), seed), F.col("inclusion"))
    extra = (rank < F.col("last")) | ((rank == F.col("last")) & F.col("last_taken"))
    copies = F.col("whole") + F.coalesce(extra.cast("long"), F.lit(0))
    return joined.select("id", "d.source", "size", "source_size", "target", copies.cast("long").alias("copies"))


def sizes_of(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", seed: int = 0) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; columns unchanged."""
    sizes = pin(sizes_of(docs, id_col, source_col, text_col))
    cut = pin(cutoffs(sizes, targets(sizes), seed)).select(
        F.col("source").alias("_ql_source"), "whole", "inclusion", "last", "last_taken"
    )
    rank = _rank(random_number(docs[id_col], seed), F.col("inclusion"))
    extra = (rank < F.col("last")) | ((rank == F.col("last")) & F.col("last_taken"))
    copies = (F.col("whole") + F.coalesce(extra.cast("long"), F.lit(0))).cast("int")
    taken = docs.join(cut, _same(docs[source_col], F.col("_ql_source"))).where(copies > 0)
    return taken.select(*[docs[c] for c in docs.columns], F.explode(F.sequence(F.lit(1), copies)).alias("_ql_copy")).drop("_ql_copy")
