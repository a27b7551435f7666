"""Licence detection by ordered signature rules.

Every rule is a regular expression over normalised text (lower-case words with
single blanks), with a literal that the text must contain before the expression
is tried, a priority and a confidence.  A detection that lies inside another of
the same or a higher priority is suppressed; among equal stretches the higher
priority wins, then the label that sorts first.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Everything in ASCII but digits and letters parts words.
NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    label: str
    pattern: str
    keyword: str  # literals that the text must contain
    gate: str
    priority: int  # 0 to 3
    confidence: float
    base: bool


# Phrases asked for by name: always detected, never suppressed.
BASE_PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)

# Label, name as it stands in running text, literal that the name contains.
NAMES = (
    ("mit", r"mit(?: expat)?", " mit "),
    ("mit", r"expat", " expat "),
    ("mit-0", r"mit (?:0|no attribution)", " mit "),
    ("apache-2", r"apache(?: software)?(?: licen[cs]e)?(?: version| v)? ?2(?: 0)?", " apache "),
    ("apache-1.1", r"apache(?: software)?(?: licen[cs]e)?(?: version| v)? ?1 1", " apache "),
    ("apache", r"apache(?: software)?", " apache "),
    ("bsd-2-clause", r"(?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd)", "bsd"),
    ("bsd-2-clause", r"freebsd", "freebsd"),
    ("bsd-3-clause", r"(?:bsd 3 clause|3 clause bsd|three clause bsd|new bsd|revised bsd|modified bsd)", "bsd"),
    ("bsd-4-clause", r"(?:bsd 4 clause|4 clause bsd|four clause bsd|original bsd)", "bsd"),
    ("bsd", r"bsd(?: style)?", " bsd "),
    ("bsd", r"berkeley software distribution", "berkeley"),
    ("isc", r"isc", " isc "),
    ("isc", r"internet systems consortium", "internet systems"),
    ("gpl-2", r"(?:gnu )?gpl(?: version| v)? ?2(?: 0)?", " gpl"),
    ("gpl-2", r"(?:gnu )?general public licen[cs]e(?: version| v)? ?2(?: 0)?", "general public"),
    ("gpl-3", r"(?:gnu )?gpl(?: version| v)? ?3(?: 0)?", " gpl"),
    ("gpl-3", r"(?:gnu )?general public licen[cs]e(?: version| v)? ?3(?: 0)?", "general public"),
    ("gpl", r"(?:gnu )?gpl", " gpl "),
    ("gpl", r"(?:gnu )?general public", "general public"),
    ("lgpl-2.1", r"(?:gnu )?lgpl(?: version| v)? ?2 1", "lgpl"),
    ("lgpl-2.1", r"(?:gnu )?lesser general public licen[cs]e(?: version| v)? ?2 1", "lesser general"),
    ("lgpl-3", r"(?:gnu )?lgpl(?: version| v)? ?3(?: 0)?", "lgpl"),
    ("lgpl-3", r"(?:gnu )?lesser general public licen[cs]e(?: version| v)? ?3(?: 0)?", "lesser general"),
    ("lgpl", r"(?:gnu )?lgpl", " lgpl "),
    ("lgpl", r"(?:gnu )?(?:lesser|library) general public", "general public"),
    ("agpl-3", r"(?:gnu )?agpl(?: version| v)? ?3(?: 0)?", "agpl"),
    ("agpl-3", r"(?:gnu )?affero general public licen[cs]e(?: version| v)? ?3(?: 0)?", "affero general"),
    ("agpl", r"(?:gnu )?agpl", " agpl "),
    ("agpl", r"(?:gnu )?affero general public", "affero general"),
    ("gfdl", r"(?:gnu )?gfdl", " gfdl "),
    ("gfdl", r"(?:gnu )?free documentation", "free documentation"),
    ("mpl-2", r"mpl(?: version| v)? ?2(?: 0)?", " mpl"),
    ("mpl-2", r"mozilla public licen[cs]e(?: version| v)? ?2(?: 0)?", "mozilla public"),
    ("mpl-1.1", r"mpl(?: version| v)? ?1 1", " mpl"),
    ("mpl-1.1", r"mozilla public licen[cs]e(?: version| v)? ?1 1", "mozilla public"),
    ("mpl", r"mpl", " mpl "),
    ("mpl", r"mozilla public", "mozilla public"),
    ("epl-1", r"epl(?: version| v)? ?1(?: 0)?", " epl"),
    ("epl-1", r"eclipse public licen[cs]e(?: version| v)? ?1(?: 0)?", "eclipse public"),
    ("epl-2", r"epl(?: version| v)? ?2(?: 0)?", " epl"),
    ("epl-2", r"eclipse public licen[cs]e(?: version| v)? ?2(?: 0)?", "eclipse public"),
    ("cddl", r"cddl", " cddl "),
    ("cddl", r"common development and distribution", "common development"),
    ("eupl", r"eupl", " eupl "),
    ("eupl", r"european union public", "european union public"),
    ("artistic-2", r"artistic(?: licen[cs]e)?(?: version| v)? ?2(?: 0)?", " artistic "),
    ("artistic", r"(?:perl )?artistic", " artistic "),
    ("zlib", r"zlib(?: libpng)?", " zlib "),
    ("boost-1", r"boost(?: software)?(?: licen[cs]e)?(?: version| v)?(?: ?1(?: 0)?)?", " boost "),
    ("unlicense", r"unlicen[cs]e", " unlicen"),
    ("wtfpl", r"wtfpl", " wtfpl "),
    ("python-2", r"python software foundation", "python software"),
    ("python-2", r"psf", " psf "),
    ("postgresql", r"postgresql", " postgresql "),
    ("openssl", r"openssl", " openssl "),
    ("ofl-1.1", r"(?:sil )?ofl(?: version| v)?(?: ?1 1)?", " ofl "),
    ("ofl-1.1", r"(?:sil )?open font licen[cs]e(?: version| v)?(?: ?1 1)?", "open font"),
    ("odbl", r"odbl", " odbl "),
    ("odbl", r"open (?:data commons )?(?:open )?database", " database "),
    ("cc0", r"cc ?0", " cc"),
    ("cc0", r"creative commons zero", "creative commons"),
    ("cc-by-nc-nd", r"cc by nc nd", "cc by nc"),
    ("cc-by-nc-nd", r"creative commons attribution non ?commercial no ?deriv\w*", "creative commons"),
    ("cc-by-nc-sa", r"cc by nc sa", "cc by nc"),
    ("cc-by-nc-sa", r"creative commons attribution non ?commercial share ?alike", "creative commons"),
    ("cc-by-nc", r"cc by nc", "cc by nc"),
    ("cc-by-nc", r"creative commons attribution non ?commercial", "creative commons"),
    ("cc-by-nd", r"cc by nd", "cc by nd"),
    ("cc-by-nd", r"creative commons attribution no ?deriv\w*", "creative commons"),
    ("cc-by-sa", r"cc by sa", "cc by sa"),
    ("cc-by-sa", r"creative commons attribution share ?alike", "creative commons"),
    ("cc-by", r"cc by", " cc by "),
    ("cc-by", r"creative commons attribution", "creative commons"),
    ("cc", r"creative commons", "creative commons"),
)

# Rule kinds: pattern around a name, gate literal, priority, confidence.
FRAMES = (
    (r"this (?:\w+ )?(?:work|software|program|file|library|project|document|text|material) (?:is|are) (?:\w+ )?"
     r"(?:licen[cs]ed|released|distributed|available|published) under (?:the |an? )?(?:terms of the )?{name}(?: licen[cs]e)?",
     "under", 3, 0.98),
    (r"(?:dual )?licen[cs]ed under (?:the |an? )?(?:terms of the )?{name}(?: licen[cs]e)?", "under", 3, 0.95),
    (r"(?:released|distributed|redistributed|available|published|provided|covered|shared) under (?:the |an? )?"
     r"(?:terms of the )?{name}(?: licen[cs]e)?", "under", 3, 0.9),
    (r"(?:subject to|governed by|in accordance with|compliance with) the (?:terms of the )?{name}(?: licen[cs]e)?", "the", 2, 0.85),
    (r"spdx licen[cs]e identifier {name}", "spdx", 3, 1.0),
    (r"(?:the )?{name} licen[cs]e", "licen", 1, 0.7),
)

# Rules that stand alone.
NOTICES = (
    Rule("proprietary", r"all rights (?:are )?reserved", "rights", "", 1, 0.6, False),
    Rule("proprietary", r"(?:proprietary and confidential|confidential and proprietary)", "proprietary", "", 2, 0.8, False),
    Rule("proprietary", r"(?:no part of this \w+ may be reproduced|may not be reproduced without)", "reproduced", "", 2, 0.8, False),
    Rule("proprietary", r"unauthori[sz]ed (?:copying|use|distribution)", "unauthori", "", 2, 0.7, False),
    Rule("copyright", r"copyright (?:c )?(?:19|20)\d\d(?: (?:19|20)?\d\d)?", "copyright", "", 0, 0.4, False),
    Rule("copyright", r"(?:c )?copyright (?:by|holders?|owners?|notice)", "copyright", "", 0, 0.3, False),
    Rule("public-domain", r"(?:in|into|to) the public domain", "public domain", "", 2, 0.8, False),
    Rule("public-domain", r"public domain (?:work|dedication|mark|software)", "public domain", "", 2, 0.8, False),
    Rule("mit", r"permission is hereby granted free of charge to any person obtaining a copy", "hereby granted", "", 3, 0.95, False),
    Rule("mit", r"the above copyright notice and this permission notice shall be included", "permission notice", "", 3, 0.9, False),
    Rule("bsd", r"redistribution and use in source and binary forms", "redistribution and use", "", 2, 0.9, False),
    Rule("bsd-3-clause", r"neither the name of (?:the )?(?:\w+ ){1,8}nor the names of (?:its|the) contributors", "neither the name", "", 3, 0.9, False),
    Rule("isc", r"permission to use copy modify and or distribute this software for any purpose", "permission to use", "", 3, 0.95, False),
    Rule("zlib", r"this software is provided as is without any express or implied warranty", "express or implied", "", 1, 0.6, False),
    Rule("gpl", r"you can redistribute it and or modify it under the terms of the gnu general public", "redistribute it", "", 3, 0.9, False),
    Rule("lgpl", r"under the terms of the gnu lesser general public", "gnu lesser", "", 3, 0.9, False),
    Rule("agpl", r"under the terms of the gnu affero general public", "gnu affero", "", 3, 0.9, False),
    Rule("apache-2", r"you may obtain a copy of the license at http www apache org licenses license 2 0", "apache org", "", 3, 1.0, False),
    Rule("unlicense", r"this is free and unencumbered software released into the public domain", "unencumbered", "", 3, 1.0, False),
    Rule("boost-1", r"permission is hereby granted free of charge to any person or organi[sz]ation obtaining", "hereby granted", "", 3, 0.95, False),
    Rule("warranty-disclaimer", r"without warrant(?:y|ies) (?:of any kind|or conditions)", "without warrant", "", 0, 0.4, False),
    Rule("share-alike", r"share ?alike (?:terms|condition|licen[cs]e)", "alike", "", 1, 0.5, False),
    Rule("non-commercial", r"(?:non ?commercial (?:use|purposes) only|for non ?commercial (?:use|purposes))", "commercial", "", 1, 0.5, False),
)


def rules() -> list[Rule]:
    """All rules: the base phrases, every name in every frame, the notices."""
    named = [
        Rule(label, frame.format(name=name), word, gate, priority, confidence, False)
        for label, name, word in NAMES
        for frame, gate, priority, confidence in FRAMES
    ]
    return [Rule(label, phrase, phrase, "", 3, 1.0, True) for label, phrase in BASE_PHRASES] + named + list(NOTICES)


def gates() -> list[str]:
    """Literals, of which any text with a detection has one."""
    return sorted({gate for _, gate, _, _ in FRAMES if gate != "the"} | {"the terms", "subject to", "governed by", "accordance with", "compliance with", "cc by nc"} | {r.keyword for r in NOTICES})


def _literal(rule: Rule) -> Column:
    return F.struct(
        F.lit(f"(?<= ){rule.pattern}(?= )").alias("pattern"), F.lit(rule.keyword).alias("keyword"), F.lit(rule.gate).alias("gate"),
        F.lit(3 - rule.priority).alias("rank"), F.lit(rule.label).alias("label"),
        F.lit(rule.confidence).alias("confidence"), F.lit(rule.base).alias("base"),
    )


FOUND = "array<struct<start:int,minus_end:int,rank:int,label:string,confidence:double,base:boolean>>"


def _blanks(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _places(words: Column, rule: Column) -> Column:
    """Detections of one rule: word places, end exclusive.

    The text is split at the matches; counting the blanks of the parts and of the
    matches in turn gives the word at which each match stands.
    """
    parts = F.call_function("split", words, rule["pattern"], F.lit(-1))
    matches = F.regexp_extract_all(words, rule["pattern"], F.lit(0))

    def steps_of(cut: Column) -> Column:
        return F.zip_with(
            F.transform(F.slice(cut["parts"], F.lit(1), F.size(cut["matches"])), _blanks),
            F.transform(cut["matches"], _blanks),
            lambda before, inside: F.struct(before.alias("before"), inside.alias("inside")),
        )

    def detection(start: Column, step: Column) -> Column:
        return F.struct(
            start.alias("start"), (-(start + step["inside"] + 1)).alias("minus_end"), rule["rank"].alias("rank"),
            rule["label"].alias("label"), rule["confidence"].alias("confidence"), rule["base"].alias("base"),
        )

    def detections(steps: Column) -> Column:
        widths = F.transform(steps, lambda step: step["before"] + step["inside"])
        found = F.zip_with(steps, _let(widths, _sums_before), lambda step, before: detection(before + step["before"] - 1, step))
        return F.when(F.size(steps) > 0, found).otherwise(F.array().cast(FOUND))

    return _let(_let(F.struct(parts.alias("parts"), matches.alias("matches")), steps_of), detections)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once; an expression named inside of a
    lambda would be computed for every element."""
    return F.transform(F.array(value), body)[0]


def _plain_sums_before(values: Column) -> Column:
    """For each of a few numbers the sum of those before it (copies the list at every step)."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("sums"))

    def add(state: Column, x: Column) -> Column:
        return F.struct((state["at"] + x).alias("at"), F.concat(state["sums"], F.array(state["at"])).alias("sums"))

    return F.aggregate(values, start, add)["sums"]


def _sums_before(values: Column) -> Column:
    """For each of many numbers the sum of those before it.  They are cut into parts,
    and the parts into parts again, so that no list longer than the cube root of all
    is copied at every step."""

    def summed(values: Column, levels: int) -> Column:
        if levels == 1:
            return _plain_sums_before(values)

        def of_parts(bound: Column) -> Column:
            v, width = bound["v"], bound["width"]
            parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / width).cast("int")), lambda k: F.slice(v, k * width + 1, width))

            def joined(parts: Column) -> Column:
                totals = F.transform(parts, lambda p: F.aggregate(p, F.lit(0), lambda a, x: a + x))
                inner = F.transform(parts, lambda p: summed(p, levels - 1))
                return F.flatten(F.zip_with(inner, _plain_sums_before(totals), lambda sums, before: F.transform(sums, lambda s: s + before)))

            return _let(parts, joined)

        width = F.ceil(F.pow(F.size(values).cast("double"), F.lit((levels - 1) / levels))).cast("int")
        return _let(F.struct(values.alias("v"), F.greatest(width, F.lit(1)).alias("width")), of_parts)

    # A few numbers need no parts.
    return F.when(F.size(values) <= 32, _plain_sums_before(values)).otherwise(summed(values, 3))


def _unsuppressed(found: Column) -> Column:
    """Labels and best confidence of what no stretch of equal or higher priority covers.

    Sorted by start, then longest, then priority, a covering detection always
    comes first, so the furthest end seen for each priority decides.
    """
    levels = range(4)

    def add(state: Column, d: Column) -> Column:
        end = -d["minus_end"]
        reach = F.greatest(*[F.when(d["rank"] >= k, state[f"reach{k}"]).otherwise(-1) for k in levels])
        kept = reach < end
        return F.struct(
            *[F.when(d["rank"] == k, F.greatest(state[f"reach{k}"], end)).otherwise(state[f"reach{k}"]).alias(f"reach{k}") for k in levels],
            F.when(kept, F.array_union(state["labels"], F.array(d["label"]))).otherwise(state["labels"]).alias("labels"),
            F.when(kept, F.greatest(state["score"], d["confidence"])).otherwise(state["score"]).alias("score"),
            (state["n"] + kept.cast("int")).alias("n"),
        )

    start = F.struct(
        *[F.lit(-1).alias(f"reach{k}") for k in levels], F.array().cast("array<string>").alias("labels"),
        F.lit(0.0).alias("score"), F.lit(0).alias("n"),
    )
    return F.aggregate(F.array_sort(found), start, add)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, found, kept) for every row, in one pass without a shuffle.

    ``found`` holds all detections before suppression: start word, minus the end
    word, 3 - priority, label, confidence, base; ``kept`` the labels, the best
    confidence and the number of those that remain.  Null counts as empty: no
    words, no detections.  Repeated rows and null ids give a row each.
    """
    spaced = F.trim(F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), NOT_WORD, " "))
    rows = docs.select(F.col(id_col), F.concat(F.lit(" "), spaced, F.lit(" ")).alias("_ql_words"))
    rows = rows.select("*", F.lower("_ql_words").alias("_ql_lowered"))
    open_ = F.lit(False)
    for gate in gates():
        open_ = open_ | F.contains(F.col("_ql_lowered"), F.lit(gate))
    rows = rows.select(
        F.col(id_col),
        F.when(F.col("_ql_words") == "  ", 0).otherwise(_blanks(F.col("_ql_words")) - 1).cast("long").alias("n_words"),
        F.when(open_, F.translate("_ql_words", UPPER, LOWER)).alias("_ql_words"),
    )
    table = F.array(*[_literal(r) for r in rules()])
    literals = F.array(*[F.lit(x) for x in sorted({r.keyword for r in rules()} | {r.gate for r in rules()})])
    present = F.when(F.col("_ql_words").isNotNull(), F.filter(literals, lambda x: F.contains(F.col("_ql_words"), x)))
    rows = rows.select("*", present.alias("_ql_present"))
    wanted = F.filter(
        table,
        lambda r: F.array_contains(F.col("_ql_present"), r["keyword"]) & F.array_contains(F.col("_ql_present"), r["gate"]),
    )
    found = F.when(F.col("_ql_words").isNotNull(), F.flatten(F.transform(wanted, lambda r: _places(F.col("_ql_words"), r))))
    none = F.array().cast(FOUND)
    rows = rows.select(F.col(id_col), "n_words", F.coalesce(found, none).alias("found"))
    return rows.select("*", _unsuppressed(F.col("found")).alias("kept"))


def license_digest(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row of counts and labels for each row of ``scan_licenses``."""
    base = F.filter("found", lambda d: d["base"])
    base_labels = F.array_distinct(F.transform(base, lambda d: d["label"]))
    starts = F.transform(base, lambda d: d["start"])
    return scanned.select(
        id_col, "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        F.array_join(F.array_sort(base_labels), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base_labels, F.col("kept.labels"))), ",").alias("labels"),
        F.col("kept.score").alias("score"), F.col("kept.n").cast("long").alias("n_kept"),
    )
