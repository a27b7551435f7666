"""Dropping of lines whose template recurs in other documents.

Templates live in a tree of fixed depth: the number of tokens, then the leading
tokens, then the leaf.  Tokens with a digit are variable fields everywhere.  In
a leaf a line proposes the template with all its tokens, and for each of
STRETCHES stretches after the leading tokens the template in which that stretch
is a variable field; four fifths of the tokens after the leading ones stay
fixed.  A line belongs to the proposed templates that lines of other documents
propose too.

A leaf's lines are never brought together, as a sequential parser would: the
proposals are counted by their hashes, combined in every task before the
shuffle, so a leaf or a template that holds a third of all rows is a few rows a
task, and the result doesn't depend on the order of lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEADING_TOKENS = 2
STRETCHES = 5
# Shorter lines have no stretch templates; their whole-line template counts if ``short_lines`` is set.
LEAST_TOKENS = 4
LEAST_DOCUMENTS = 2
VARIABLE = "<*>"
# A token with a digit; the look-behind and the possessive class keep the match linear.
_DIGIT_TOKEN = r"(?<!\S)[^\s\d]*+\d\S*"


def masked(line: Column) -> Column:
    """The line with every token that has a digit as the variable field."""
    return F.when(F.rlike(line, F.lit("[0-9]")), F.regexp_replace(line, _DIGIT_TOKEN, VARIABLE)).otherwise(line)


def _edge(k: int) -> Column:
    """Tokens before stretch k of a line of n tokens."""
    return F.floor(F.greatest(F.col("n") - LEADING_TOKENS, F.lit(0)) * k / STRETCHES).cast("int") + LEADING_TOKENS


def _proposals(docs: DataFrame, id_col: str, text_col: str, short_lines: bool) -> DataFrame:
    """(_ql_id, line, h, g): for each line and template 96 bits of hash.

    Tokens stand between single blanks.  Each stretch is hashed once, with its
    place; a template is the exclusive or of the hashes of all stretches but the
    variable one.  Stretches are cut as bytes, which stays in generated code.
    """
    stretches = range(STRETCHES)
    lines = docs.select(F.col(id_col).alias("_ql_id"), F.posexplode(F.split(F.col(text_col), "\n")).alias("line", "content"))
    lines = lines.select("_ql_id", "line", masked(F.col("content")).alias("content"))
    blanks = F.octet_length("content") - F.octet_length(F.replace(F.col("content"), F.lit(" "), F.lit("")))
    lines = lines.select("*", (blanks + 1).alias("n"))
    # A line of digits and signs alone is not a template.
    lines = lines.withColumn("short", (F.col("n") < LEAST_TOKENS) & F.rlike("content", F.lit(r"\p{L}")) if short_lines else F.lit(False))
    lines = lines.select("*", *[_edge(k).alias(f"e{k}") for k in range(STRETCHES + 1)])
    lines = lines.select("*", *[F.expr(f"substring_index(content, ' ', e{k})").alias(f"upto{k}") for k in range(STRETCHES + 1)])
    parts = lines.select(
        "_ql_id", "line", "n", "short", *[f"e{k}" for k in range(STRETCHES + 1)], F.col("upto0").alias("lead"),
        *[
            F.substr(
                F.col("content").cast("binary"), F.octet_length(f"upto{k}") + 1,
                F.octet_length(f"upto{k + 1}") - F.octet_length(f"upto{k}"),
            ).alias(f"part{k}")
            for k in stretches
        ],
    )
    hashes = parts.select(
        "_ql_id", "line", "n", "short", *[f"e{k}" for k in range(STRETCHES + 1)],
        F.xxhash64("lead", "n").alias("h_lead"), F.hash("lead", "n").alias("g_lead"),
        *[F.xxhash64(f"part{k}", F.lit(k)).alias(f"h{k}") for k in stretches],
        *[F.hash(f"part{k}", F.lit(k)).alias(f"g{k}") for k in stretches],
    )
    whole = {side: F.col(f"{side}_lead") for side in "hg"}
    for k in stretches:
        whole = {side: whole[side].bitwiseXOR(F.col(f"{side}{k}")) for side in "hg"}
    hashes = hashes.withColumns({"h": whole["h"], "g": whole["g"]})

    def proposed(k: int) -> Column:
        """A variable stretch needs a token, and its line fixed tokens enough."""
        width = F.col(f"e{k + 1}") - F.col(f"e{k}")
        allowed = (width > 0) & (F.col("n") - width >= LEAST_TOKENS)
        return F.when(allowed, F.struct(F.col("h").bitwiseXOR(F.col(f"h{k}")).alias("h"), F.col("g").bitwiseXOR(F.col(f"g{k}")).alias("g")))

    templates = F.array(F.struct("h", "g"), *[proposed(k) for k in stretches])
    proposals = F.when(F.col("n") >= LEAST_TOKENS, templates).when(F.col("short"), F.array(F.struct("h", "g")))
    rows = hashes.select("_ql_id", "line", F.explode(proposals).alias("t"))
    return rows.where(F.col("t").isNotNull()).select("_ql_id", "line", "t.h", "t.g")


def recurring_templates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_DOCUMENTS, short_lines: bool = False,
) -> DataFrame:
    """(h, g, first_id) of templates that lines of ``least`` documents or more propose.

    A document counts once for a template, and rows that share an id count as one.
    """
    seen = _proposals(docs, id_col, text_col, short_lines).select("_ql_id", "h", "g")
    if least <= 2:
        counted = seen.groupBy("h", "g").agg(F.min("_ql_id").alias("first_id"), F.max("_ql_id").alias("last_id"))
        return counted.where("first_id < last_id").select("h", "g", "first_id")
    counted = seen.distinct().groupBy("h", "g").agg(F.count("*").alias("n_documents"), F.min("_ql_id").alias("first_id"))
    return counted.where(F.col("n_documents") >= least).select("h", "g", "first_id")


def drop_recurring_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_DOCUMENTS, short_lines: bool = False,
) -> DataFrame:
    """The rows of ``docs`` with recurring lines taken out of the text, plus
    ``_ql_n_lines`` and ``_ql_n_dropped``.

    A line goes when one of its templates recurs in ``least`` documents and an
    earlier document (by id) has it; the first document keeps its lines, so the
    content stays once.  Lines under LEAST_TOKENS tokens stay, unless
    ``short_lines`` is set: then those with a letter outside of variable tokens
    go as whole lines.  Null texts stay null, empty ones empty; a row without an
    id neither counts nor loses lines; rows that share an id are one document,
    and a line goes from all of them.
    Columns beside id and text are passed through.
    """
    found = recurring_templates(docs, id_col, text_col, least, short_lines)
    dropped = (
        _proposals(docs, id_col, text_col, short_lines)
        .join(found, ["h", "g"])
        .where(F.col("_ql_id") > F.col("first_id"))
        .groupBy("_ql_id")
        .agg(F.collect_set("line").alias("_ql_lines"))
    )
    lines = F.split(F.col(text_col), "\n")
    gone = F.coalesce(F.col("_ql_lines"), F.array().cast("array<int>"))
    # Lines and marks in one order: a line that goes has its mark behind it.
    numbered = F.transform(lines, lambda x, i: F.struct(i.alias("line"), F.lit(0).alias("mark"), x.alias("text")))
    marks = F.transform(gone, lambda i: F.struct(i.alias("line"), F.lit(1).alias("mark"), F.lit(None).cast("string").alias("text")))
    ordered = F.sort_array(F.concat(numbered, marks))
    following = F.slice(ordered, 2, 2**30)
    # Joining leaves out nulls.
    kept = F.zip_with(ordered, following, lambda x, after: F.when(F.coalesce(after["mark"], F.lit(0)) == 0, x["text"]))
    joined = docs.join(dropped, docs[id_col] == F.col("_ql_id"), "left")
    return joined.select(
        *[
            F.when(F.col("_ql_lines").isNull(), docs[c]).otherwise(F.array_join(kept, "\n")).alias(c) if c == text_col else docs[c]
            for c in docs.columns
        ],
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("_ql_n_lines"),
        F.size(gone).cast("long").alias("_ql_n_dropped"),
    )
