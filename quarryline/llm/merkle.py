"""Document fingerprints: a Merkle tree over paragraphs and sections.

A paragraph (leaf) is a stretch that ends with a line or a sentence; longer
stretches are cut at PARAGRAPH_CHARS code points.  A section is a run of
paragraphs that ends where a paragraph's hash says so, so an edit moves no
later border but its own.  Leaves are hashed to sections, sections to the root.

The fingerprint is the root, a colon, and the first digits of every leaf with a
dot behind each section.  Roots test equality; sections and leaves that differ
locate the edits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarryline.session import pin

PARAGRAPH_CHARS = 100
PARAGRAPH = rf"[^\n.!?]{{0,{PARAGRAPH_CHARS}}}[.!?\n]+|[^\n.!?]{{1,{PARAGRAPH_CHARS}}}"
# One paragraph in eight ends a section: those whose hash begins with one of these digits.
SECTION_ENDS = "01"
LEAF_DIGITS = 8
ROOT_DIGITS = 64


def _ends_section(leaf: Column) -> Column:
    return F.substring(leaf, 1, 1).isin(*SECTION_ENDS)


def leaf_hashes(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(PARAGRAPH), F.lit(0)), F.md5)


def _joined(leaves: Column, digits: int) -> Column:
    dotted = F.transform(
        leaves, lambda x: F.concat(F.substring(x, 1, digits), F.when(_ends_section(x), ".").otherwise(""))
    )
    return F.array_join(dotted, "")


def fingerprint(leaves: Column) -> Column:
    """The fingerprint string of an array of leaf hashes."""
    sections = F.filter(F.split(_joined(leaves, 32), r"\."), lambda s: s != "")
    root = F.sha2(F.array_join(F.transform(sections, F.md5), ""), 256)
    return F.concat(root, F.lit(":"), _joined(leaves, LEAF_DIGITS))


def leaves_of(print_: Column) -> Column:
    """The distinct leaves of a fingerprint."""
    body = F.translate(F.substr(print_, F.lit(ROOT_DIGITS + 2)), ".", "")
    return F.array_distinct(F.regexp_extract_all(body, F.lit(f"[0-9a-f]{{{LEAF_DIGITS}}}"), F.lit(0)))


def likeness(one: Column, other: Column, equal: Column) -> Column:
    """Shared leaves among the distinct leaves of two trees (Dice); 1 for equal roots."""
    both = F.size(F.array_intersect(one, other))
    total = F.size(one) + F.size(other)
    return F.when(equal, 1.0).when(total == 0, 1.0).otherwise(2.0 * both / F.greatest(total, F.lit(1)))


def differing_sections(one: Column, other: Column) -> Column:
    """Sections (dotted leaf strings) of the first fingerprint that the second lacks: where the edits are."""

    def parts(print_: Column) -> Column:
        return F.filter(F.split(F.substr(print_, F.lit(ROOT_DIGITS + 2)), r"\."), lambda s: s != "")

    return F.array_except(parts(one), parts(other))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint) for every row; null counts as empty, an empty text has no leaf."""
    leaves = docs.select(id_col, leaf_hashes(F.coalesce(F.col(text_col), F.lit(""))).alias("_ql_leaves"))
    return leaves.select(id_col, fingerprint(F.col("_ql_leaves")).alias("fingerprint"))


def _following(keys: DataFrame, parts: int) -> DataFrame:
    """Rows of (id, h, ...) with the next row's (next_id, next_h) by id and h, after the last the first.

    Keys are dealt by range; each part finds its own successors, and the last key
    of a part is followed by the first of the next part.  Null ids come first.
    """
    dealt = pin(keys.repartitionByRange(parts, "id", "h").withColumn("part", F.spark_partition_id()))
    firsts = dealt.groupBy("part").agg(F.min(F.struct("id", "h")).alias("own"))
    everywhere = Window.orderBy("part")
    firsts = firsts.select(
        "part",
        F.coalesce(F.lead("own").over(everywhere), F.first("own").over(everywhere)).alias("beyond"),
    )
    nearby = F.lead(F.struct("id", "h")).over(Window.partitionBy("part").orderBy("id", "h"))
    linked = dealt.withColumn("near", nearby).join(firsts, "part")
    following = F.coalesce("near", "beyond")
    return linked.select("id", "h", "n", following["id"].alias("next_id"), following["h"].alias("next_h"))


def edit_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness.

    The edited text has its last quarter (floor of code points / 4) replaced by
    as many first code points of the next document, or all it has.  Returns id,
    n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, n_differing (sections that the edited tree lacks), a row for each row.

    Next is by ascending id, null first, then by a hash of the text; after the
    last comes the first.  Rows that repeat both id and text are one document
    here and get equal results.  Null counts as empty.  A lone document follows itself.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("h"))
    keys = own.select("id", "h", F.length("text").alias("n")).distinct()
    shuffles = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    links = pin(_following(keys, shuffles))

    asked = links.select(
        F.col("next_id").alias("id_"), F.col("next_h").alias("h_"),
        F.col("id").alias("to_id"), F.col("h").alias("to_h"), F.floor(F.col("n") / 4).cast("int").alias("wanted"),
    )
    giving = own.join(asked, own["id"].eqNullSafe(F.col("id_")) & (own["h"] == F.col("h_")))
    giving = giving.select(
        "to_id", "to_h", F.substr("text", F.lit(1), F.col("wanted")).alias("head"), leaf_hashes(F.col("text")).alias("leaves")
    )
    giving = giving.select("to_id", "to_h", "head", fingerprint(F.col("leaves")).alias("next_print"))
    giving = giving.dropDuplicates(["to_id", "to_h"])

    joined = own.join(giving, own["id"].eqNullSafe(F.col("to_id")) & (own["h"] == F.col("to_h")))
    joined = joined.withColumn("n_chars", F.length("text"))
    kept = F.substr("text", F.lit(1), F.col("n_chars") - F.floor(F.col("n_chars") / 4).cast("int"))
    joined = joined.withColumn("edited", F.concat(kept, F.col("head")))
    joined = joined.select(
        "id", F.col("n_chars").cast("long").alias("n_chars"), F.sha2(F.col("edited"), 256).alias("edited_sha256"), "next_print",
        leaf_hashes(F.col("text")).alias("leaves"), leaf_hashes(F.col("edited")).alias("edited_leaves"),
    )
    joined = joined.select(
        "id", "n_chars", "edited_sha256", "next_print",
        fingerprint(F.col("leaves")).alias("fingerprint"), fingerprint(F.col("edited_leaves")).alias("edited_fingerprint"),
    )
    joined = joined.select(
        "*", leaves_of(F.col("fingerprint")).alias("a"), leaves_of(F.col("edited_fingerprint")).alias("b"), leaves_of(F.col("next_print")).alias("c")
    )
    return joined.select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("a"), F.col("b"), F.col("fingerprint") == F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("a"), F.col("c"), F.col("fingerprint") == F.col("next_print")).alias("near_next"),
        F.size(differing_sections(F.col("fingerprint"), F.col("edited_fingerprint"))).cast("long").alias("n_differing"),
    )
