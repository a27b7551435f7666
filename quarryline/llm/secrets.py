"""Secret scans: patterns propose findings, a random forest removes the false ones.

A finding is described by its length, the transitions between its characters,
how much of it dictionary words cover, its path and the words beside it.  The
forest is trained from labelled findings.  Where no labelled table exists, rules
that are sure of themselves label a part of the findings (``weak_label``); the
forest then judges all of them, those that no rule could label included.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.session import pin

# Words and letter pairs of all documents count from this share on, the same at every size of table;
# so there are at most a million of each.  A word has to stand there LEAST_COUNT times at least.
LEAST_SHARE = 1e-6
LEAST_COUNT = 5
# The widths that describe() looks for.
LEAST_WORD, MOST_WORD = 4, 14
# Bounds of the labelled findings that the forest is fitted on.
TRAIN_DOCUMENTS = 60_000
TRAIN_FINDINGS = 20_000
TREES, DEPTH = 24, 6
SECRET_FROM = 0.5
NEAR_CHARS = 40

KNOWN_FORMS = {
    "aws_key": r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9])",
    "github_token": r"(?<![A-Za-z0-9])gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])",
    "slack_token": r"(?<![A-Za-z0-9])xox[abprs]-[A-Za-z0-9-]{10,}+",
    "web_token": r"(?<![A-Za-z0-9])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+",
    "private_key": r"-----BEGIN (?:[A-Z]{2,9} ){0,2}PRIVATE KEY-----",
}
CREDENTIAL_WORDS = "token|secret|passw(?:or)?d|passwd|pwd|api[_-]?key|access[_-]?key|auth|credential|private[_-]?key"
_KNOWN = [(name, re.compile(p)) for name, p in KNOWN_FORMS.items()]
_ASSIGNED = re.compile(rf"(?i:{CREDENTIAL_WORDS})[\w-]{{0,16}}[ \t]{{0,2}}[:=][ \t]{{0,2}}[\"']?([^\s\"'`,;]{{8,}}+)")
_ASSIGNING = re.compile(rf"(?i:{CREDENTIAL_WORDS})[\w-]{{0,16}}[ \t]{{0,2}}[:=][ \t]{{0,2}}[\"']?\Z")
_GENERIC = re.compile(r"[A-Za-z0-9+/_=-]{16,}+")
_CREDENTIAL = re.compile(CREDENTIAL_WORDS, re.I)
_HARMLESS = re.compile(r"example|sample|dummy|placeholder|your[_-]|xxxx|test|changeme|card|phone|order|isbn", re.I)
_TEST_PATH = re.compile(r"test|example|sample|spec|fixture|mock|doc", re.I)
_CONFIG_PATH = re.compile(r"\.(?:env|ya?ml|json|ini|cfg|conf|toml|properties|pem)\b|config|secret", re.I)

FEATURES = (
    "length", "entropy", "distinct", "digit_share", "upper_share", "class_changes", "bigram_surprise",
    "dictionary_share", "is_hex", "path_depth", "test_path", "config_path", "credential_near", "harmless_near",
    "assigned", "quoted", "letters_beside",
)


class WordLists(NamedTuple):
    words: frozenset[str]
    bigrams: dict[str, float]  # negative log probability
    unseen: float


class Finding(NamedTuple):
    start: int
    end: int
    rule: str


def candidates(text: str) -> list[Finding]:
    """Proposed findings by start, none inside another."""
    found = [Finding(m.start(), m.end(), rule) for rule, p in _KNOWN for m in p.finditer(text)]
    if "=" in text or ":" in text:
        found += [Finding(m.start(1), m.end(1), "assigned") for m in _ASSIGNED.finditer(text)]
    for m in _GENERIC.finditer(text):
        if any(map(str.isdigit, m[0])):
            found.append(Finding(m.start(), m.end(), "generic"))
    found.sort(key=lambda f: (f.start, -f.end))
    kept: list[Finding] = []
    for f in found:
        if not kept or f.start >= kept[-1].end:
            kept.append(f)
        elif f.end > kept[-1].end:
            kept[-1] = Finding(kept[-1].start, f.end, kept[-1].rule)
    return kept


def entropy(value: str) -> float:
    return -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())


def _kind(c: str) -> str:
    return "d" if c.isdigit() else "u" if c.isupper() else "l" if c.isalpha() else "s"


def _covered(value: str, words: frozenset[str]) -> float:
    """Share of the letters that dictionary words of LEAST_WORD to MOST_WORD letters cover, the longest first."""
    lowered, at, covered = value.lower(), 0, 0
    letters = sum(map(str.isalpha, lowered))
    while at < len(lowered):
        width = next((w for w in range(min(MOST_WORD, len(lowered) - at), LEAST_WORD - 1, -1) if lowered[at : at + w] in words), 0)
        covered += width
        at += width or 1
    return covered / letters if letters else 0.0


def describe(text: str, finding: Finding, path: str, lists: WordLists) -> list[float]:
    """The features of a finding, of its whole value."""
    value = text[finding.start : finding.end]
    before, after = text[max(0, finding.start - NEAR_CHARS) : finding.start], text[finding.end : finding.end + NEAR_CHARS]
    near = before + " " + after
    kinds = [_kind(c) for c in value]
    pairs = [a + b for a, b in zip(value.lower(), value.lower()[1:])]
    surprise = sum(lists.bigrams.get(p, lists.unseen) for p in pairs) / max(len(pairs), 1)
    return [
        float(finding.end - finding.start), entropy(value), len(set(value)) / len(value),
        kinds.count("d") / len(value), kinds.count("u") / len(value),
        sum(a != b for a, b in zip(kinds, kinds[1:])) / max(len(kinds) - 1, 1), surprise,
        _covered(value, lists.words), float(all(c in "0123456789abcdefABCDEF" for c in value)),
        float(path.count("/")), float(bool(_TEST_PATH.search(path))), float(bool(_CONFIG_PATH.search(path))),
        float(bool(_CREDENTIAL.search(near))), float(bool(_HARMLESS.search(near) or _HARMLESS.search(value))),
        float(bool(_ASSIGNING.search(before))), float(before[-1:] in "\"'" and before != ""),
        sum(map(str.isalpha, near)) / max(len(near), 1),
    ]


def weak_label(rule: str, features: list[float]) -> int | None:
    """1 or 0 where a rule is sure, else None; an assigned random value beside a harmless word is not sure."""
    f = dict(zip(FEATURES, features))
    assigned = f["assigned"] and f["entropy"] >= 3.0 and f["length"] >= 16
    if f["harmless_near"]:
        return None if assigned and f["dictionary_share"] < 0.5 else 0
    if rule in KNOWN_FORMS or assigned:
        return 1
    if f["digit_share"] == 1.0 or f["dictionary_share"] >= 0.5 or f["entropy"] < 2.5:
        return 0
    return None


def word_lists(docs: DataFrame, text_col: str = "text") -> WordLists:
    """Words and letter pairs of LEAST_SHARE or more, counted over all documents.

    Pairs are those inside of words, each as often as its words; a rarer pair
    counts as one of LEAST_SHARE.
    """
    words = docs.select(F.explode(F.split(F.lower(text_col), r"[^\p{L}]+")).alias("w")).where("length(w) >= 2")
    counted = pin(words.groupBy("w").agg(F.count("*").alias("n")))
    total = counted.agg(F.sum("n").alias("words"), F.sum(F.col("n") * (F.length("w") - 1)).alias("pairs")).first()
    if total["words"] is None:
        return WordLists(frozenset(), {}, -math.log(LEAST_SHARE))
    frequent = counted.where(F.length("w").between(LEAST_WORD, MOST_WORD))
    frequent = frequent.where(F.col("n") >= max(LEAST_COUNT, LEAST_SHARE * total["words"])).select("w")
    # All pairs in one pass over the word, however long.
    pairs = counted.select(F.explode(F.regexp_extract_all("w", F.lit("(?=(..))"), F.lit(1))).alias("p"), "n")
    pairs = pairs.groupBy("p").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_SHARE * total["pairs"])
    return WordLists(
        frozenset(r["w"] for r in frequent.collect()),
        {r["p"]: -math.log(r["n"] / total["pairs"]) for r in pairs.collect()}, -math.log(LEAST_SHARE),
    )


def _sample(docs: DataFrame, id_col: str, most: int) -> DataFrame:
    """About ``most`` documents, the same for the same ids."""
    share = min(1.0, most / max(docs.select(id_col).count(), 1))
    return docs.where(F.pmod(F.xxhash64(F.lit(10), id_col), F.lit(1_000_000)) < share * 1_000_000)


def findings(docs: DataFrame, lists: WordLists, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """(id, start, end, rule, weak, features) of every proposed finding; places in code points."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, starts, ends, rules, weak, rows = [], [], [], [], [], []
            for k, (text, path) in enumerate(zip(batch.column(1), batch.column(2))):
                text, path = text.as_py() or "", path.as_py() or ""
                for finding in candidates(text):
                    features = describe(text, finding, path, lists)
                    at.append(k), starts.append(finding.start), ends.append(finding.end), rules.append(finding.rule)
                    weak.append(weak_label(finding.rule, features)), rows.append(features)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(starts, pa.int64()), pa.array(ends, pa.int64()),
                 pa.array(rules, pa.string()), pa.array(weak, pa.int32()), pa.array(rows, pa.list_(pa.float64()))],
                ["id", "start", "end", "rule", "weak", "features"],
            )

    rows = docs.select(id_col, text_col, F.col(path_col).cast("string").alias(path_col))
    return rows.mapInArrow(scan, f"id {id_type}, start long, end long, rule string, weak int, features array<double>")


def train(labelled: DataFrame) -> RandomForestClassificationModel | None:
    """A forest from (features, label) rows, TRAIN_FINDINGS at most; None unless both labels occur."""
    rows = labelled.where("label is not null").select("features", F.col("label").cast("double").alias("label"))
    rows = pin(rows.orderBy(F.xxhash64("features"), "label").limit(TRAIN_FINDINGS))
    if rows.select("label").distinct().count() < 2:
        return None
    ready = rows.withColumn("vector", array_to_vector("features"))
    forest = RandomForestClassifier(featuresCol="vector", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=7)
    return forest.fit(ready)


def judge(found: DataFrame, model: RandomForestClassificationModel | None) -> DataFrame:
    """Findings with ``score``, the forest's probability of a secret; without a model 0.5 for all."""
    if model is None:
        return found.withColumn("score", F.lit(0.5))
    scored = model.transform(found.withColumn("vector", array_to_vector("features")))
    return scored.select(*found.columns, vector_to_array("probability")[1].alias("score"))


def scan_secrets(
    docs: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source",
) -> DataFrame:
    """(id, start, end, rule, score, is_secret) of every proposed finding of every whole text.

    ``labelled`` has (id, start, end, label) of findings whose truth is known;
    without it the weak labels of about TRAIN_DOCUMENTS documents teach the forest.
    Null texts and paths count as empty; rows that share an id are scanned one by
    one; with no findings of both labels nothing can be learned, and all are reported.
    """
    lists = word_lists(docs, text_col)
    if labelled is None:
        sample = findings(_sample(docs, id_col, TRAIN_DOCUMENTS), lists, id_col, text_col, path_col)
        taught = sample.withColumn("label", F.col("weak"))
    else:
        known = labelled.select(F.col(id_col).alias("id"), "start", "end", "label")
        holders = docs.join(known.select(F.col("id").alias("_ql_id")).distinct(), docs[id_col] == F.col("_ql_id"), "left_semi")
        taught = findings(holders, lists, id_col, text_col, path_col).join(known, ["id", "start", "end"])
    judged = judge(findings(docs, lists, id_col, text_col, path_col), train(taught))
    return judged.select(F.col("id").alias(id_col), "start", "end", "rule", "score", (F.col("score") >= SECRET_FROM).alias("is_secret"))
