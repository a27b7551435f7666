"""The operators applied to whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryline.llm import (
    conversation_repair, decontaminate, jaccard_join, language, license_rules, line_templates, merkle, mixing, pii, secrets,
    suffix_dedup, token_counts, whitening,
)
from quarryline.llm.sql import SQL

VOCABULARY_FILE = "/opt/tokenizers/piece_bpe_32k.model"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(function: Callable) -> Callable:
    QUERIES[function.__name__] = function
    return function


def _table(spark: SparkSession, folder: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query
def op1_token_counts(spark, folder):
    """Words and greedy word pieces of every document."""
    return token_counts.token_counts(_table(spark, folder), token_counts.piece_vocabulary(VOCABULARY_FILE))


@_query
def op2_line_templates(spark, folder):
    """Every document without the lines whose template an earlier document has."""
    cleaned = line_templates.drop_recurring_lines(_table(spark, folder), short_lines=True)
    return cleaned.select("doc_id", "text", F.col("_ql_n_lines").alias("n_lines"), F.col("_ql_n_dropped").alias("n_dropped"))


@_query
def op3_license_rules(spark, folder):
    """Licence labels of every document."""
    return license_rules.license_digest(license_rules.scan_licenses(_table(spark, folder)))


@_query
def op5_pareto_mix(spark, folder):
    """What the mix takes of every document."""
    mixed = mixing.mix_copies(mixing.sizes_of(_table(spark, folder)))
    return mixed.select(
        F.col("id").alias("doc_id"), "size", "source_size", F.round("target", 3).alias("target"),
        (F.col("copies") * F.col("size")).alias("taken"), "copies",
    )


@_query
def op9_merkle_prints(spark, folder):
    """Fingerprints of every document and of its edited text, and how alike they are."""
    return merkle.edit_likeness(_table(spark, folder))


@_query
def op4_pii(spark, folder):
    """Personal data in every document."""
    return pii.scan_pii(_table(spark, folder))


@_query
def op6_decontaminate(spark, folder):
    """Documents that hold a benchmark item or a near copy of one, with those items."""
    found = decontaminate.contaminated(_table(spark, folder), _table(spark, folder, "benchmark"))
    return found.groupBy("doc_id").agg(
        F.count("*").alias("n_items"), F.max("similarity").alias("similarity"),
        F.array_join(F.transform(F.array_sort(F.collect_list("item_id")), lambda x: x.cast("string")), ",").alias("item_ids"),
    )


@_query
def op7_language(spark, folder):
    """The predicted language of every document."""
    docs = _table(spark, folder)
    filters = language.train_on(docs)
    return language.predict(docs, filters, keep=["doc_id"]).select(
        "doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )


@_query
def op8_jaccard_join(spark, folder):
    """Near-duplicate class and links of every document."""
    return jaccard_join.near_duplicates(_table(spark, folder))


@_query
def op10_secrets(spark, folder):
    """Secrets of the documents that have something like one."""
    found = secrets.scan_secrets(_table(spark, folder))
    span = F.when(F.col("is_secret"), F.struct("start", "end"))
    spans = F.transform(F.array_sort(F.collect_list(span)), lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string")))
    return found.groupBy("doc_id").agg(
        F.count("*").alias("n_candidates"), F.count_if("is_secret").alias("n_secrets"),
        F.round(F.max("score"), 6).alias("score"), F.array_join(spans, ",").alias("spans"),
    )


@_query
def op11_suffix_dedup(spark, folder):
    """Bytes left of every document when all that stands at several places is removed."""
    left = suffix_dedup.drop_repeats(_table(spark, folder), keep_bytes=False)
    return left.select("doc_id", *[F.col(f"_ql_{c}").alias(c) for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256")])


@_query
def op12_whitening(spark, folder):
    """The first whitened components of every embedding."""
    names = {"component": "int", "n": "long", "deviation": "long", "whitened": "double", "explained": "double", "identity_error": "double"}
    rows = whitening.whiten(_table(spark, folder, "embeddings"))
    return rows.select("vec_id", *[F.col(f"_ql_{c}").cast(t).alias(c) for c, t in names.items()])


@_query
def op13_conversation_repair(spark, folder):
    """Faults and cheapest repair of every conversation after the test damage."""
    conversations = _table(spark, folder, "conversations")
    return conversation_repair.repair_all(conversations, conversation_repair.damaged(conversations))
