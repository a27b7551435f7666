"""The pipeline's rows against a second implementation of its five stages in plain Python."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from llm.test_many_texts import shingles, templates

import corpus_pipeline
from quarryline.llm import language


def grams(text):
    """Five-byte windows of three letters or more; every other ASCII byte is a blank."""
    data = b" " + bytes(c if c >= 0x80 or chr(c).isalpha() else 0x20 for c in text.lower().encode()) + b" "
    runs = [data[k : k + 5] for k in range(len(data) - 4)]
    return [r for r in runs if sum(c != 0x20 for c in r) >= 3]


def learned(docs):
    sets = defaultdict(set)
    for d in docs:
        if None not in (d["doc_id"], d["lang"], d["text"]) and zlib.crc32(str(d["doc_id"]).encode()) % 5:
            sets[d["lang"]].update(grams(d["text"]))
    return dict(sorted((lang, own) for lang, own in sets.items() if own))


def shares(sets, text):
    found = grams(text or "")
    return {lang: sum(g in own for g in found) / max(len(found), 1) for lang, own in sets.items()}


def identified(docs):
    sets = learned(docs)
    for d in docs:
        first, second = sorted(shares(sets, d["text"]).values(), reverse=True)[:2]
        if any(c.isalpha() for c in d["text"] or "") and first >= 0.5 and first - second >= 0.1:
            yield d


def proposals(line):
    """A line of one to three tokens counts as a whole, if a token without a digit has a letter."""
    if len(line.split(" ")) > 3:
        return templates(line)
    tokens = ["<*>" if any(c.isdigit() for c in t) else t for t in line.split(" ")]
    return {("short", *tokens)} if any(c.isalpha() for t in tokens for c in t) else set()


def without_recurring_lines(docs):
    holders = defaultdict(set)
    proposed = []
    for d in docs:
        lines = d["text"].split("\n") if d["text"] is not None else []
        proposed.append([proposals(line) for line in lines])
        for own in proposed[-1]:
            for t in own:
                if d["doc_id"] is not None:
                    holders[t].add(d["doc_id"])
    gone = {
        (d["doc_id"], k)
        for d, lines in zip(docs, proposed, strict=True) if d["doc_id"] is not None
        for k, own in enumerate(lines) if any(min(holders[t]) < d["doc_id"] for t in own)
    }
    for d in docs:
        text = "\n".join(line for k, line in enumerate(d["text"].split("\n")) if (d["doc_id"], k) not in gone)
        yield {**d, "text": text, "n_chars": len(text)}


def one_of_each_class(docs):
    sets = [frozenset(shingles(d["text"])) for d in docs]
    label = list(range(len(docs)))
    for a in range(len(docs)):
        for b in range(a):
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                old, new = label[a], label[b]
                label = [new if x == old else x for x in label]
    for k, d in enumerate(docs):
        group = [x for x, y in zip(docs, label, strict=True) if y == label[k]]
        if d is min(group, key=lambda x: (x["doc_id"] is None, x["doc_id"] or 0)):
            yield d


def without_leaks(docs, items):
    def sequence(text):
        words = text.lower().split()
        return [tuple(words[k : k + 5]) for k in range(len(words) - 4)]

    def leaks(text):
        own = sequence(text)
        for item in items:
            wanted = sequence(item)
            n = len(wanted)
            for start in range(1 - n, len(own)):
                window = Counter(own[max(start, 0) : start + n])
                if sum((window & Counter(wanted)).values()) >= 0.8 * sum((window | Counter(wanted)).values()):
                    return True
        return False

    return (d for d in docs if d["doc_id"] is None or not leaks(d["text"]))


def mixed(docs):
    size = [len(d["text"].split()) for d in docs]
    sources = sorted({d["source"] for d in docs}, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sources)}
    whole = {s: sum(n for d, n in zip(docs, size, strict=True) if d["source"] == s) for s in sources}
    target, open_, left = {}, set(sources), 1.5 * sum(whole.values())
    while True:  # a source that would get over twice its size stops there, the rest is dealt again
        each = left / sum(weight[s] for s in open_) if open_ else 0
        full = {s for s in open_ if each * weight[s] > 2 * whole[s]}
        target.update({s: 2 * whole[s] for s in full} or {s: each * weight[s] for s in open_})
        if not full:
            break
        open_ -= full
        left -= sum(target[s] for s in full)
    for s in sources:
        ratio = target[s] / whole[s] if whole[s] else 0
        copies = int(ratio + 1e-12)
        wanted, run, extra = (ratio - copies) * whole[s], 0, set()
        drawn = [k for k, d in enumerate(docs) if d["source"] == s]
        drawn.sort(key=lambda k: int(hashlib.md5(f"0:{'null' if docs[k]['doc_id'] is None else docs[k]['doc_id']}".encode()).hexdigest()[:13], 16))
        for k in drawn if ratio > copies + 1e-9 else ():
            if run >= wanted:
                break
            if run + size[k] < wanted or run + size[k] - wanted <= wanted - run:
                extra.add(k)
            run += size[k]
        for k in drawn:
            yield from [docs[k]] * (copies + (k in extra))


@pytest.fixture(scope="module")
def planted(spark, frame, tmp_path_factory):
    rng = random.Random(17)
    vocabulary = {
        "en": [a + b for a in ("stro", "whe", "thin", "gra", "lou") for b in ("ngly", "rever", "kable", "ndest", "dness", "wish")],
        "de": [a + b for a in ("zwis", "durch", "kraft", "mög", "über") for b in ("chen", "zug", "werk", "lich", "haupt", "ung")],
        "xx": [a + b for a in ("qaq", "xyv", "jij", "oqo", "vuv") for b in ("ixaq", "ojuv", "yqej", "avix", "uqoz", "ejoq")],
    }

    def words(lang, n):
        return [rng.choice(vocabulary[lang]) for _ in range(n)]

    items = [" ".join(words("en", 30)) for _ in range(6)]
    rows = []

    def add(text, lang="en", source=None, doc_id=-1):
        key = 10 * len(rows) if doc_id == -1 else doc_id
        rows.append((key, text, lang, source or rng.choice(["a", "b", "c", "d"])))

    def plain(lang):
        return "\n".join(" ".join(words(lang, rng.randrange(8, 30))) for _ in range(rng.randrange(1, 5)))

    for k in range(70):
        add(plain("en" if k % 3 else "de"), "en" if k % 3 else "de")
    for k in range(8):  # a text in an unlearned language, and one of two languages
        add(plain("xx"), None)
        add(" ".join(words("en", 40) + words("de", 40)), None)
    for k in range(8):  # a line that recurs, with a number and with a varying stretch; a short one
        add(f"{plain('en')}\nprinted wherever on page {k} of the grandest thinkable loudness\nMenu\n{plain('en')}")
        add(f"strongly {' '.join(words('en', 2))} whenever thinness was so near to all of us here\n{plain('de')}", "de")
    for _ in range(6):  # near copies in one long line, edited in two stretches
        base = words("en", 140)
        add(" ".join(base))
        for _ in range(3):
            own = list(base)
            own[rng.randrange(20, 40)], own[rng.randrange(100, 120)] = "strodness", "lounder"
            add(" ".join(own))
    copied = plain("en")
    for _ in range(3):
        add(copied)
    for item in items:  # benchmark passages, whole and with a word changed
        own = item.split()
        own[12] = "whendest"
        add(" ".join(words("en", 15) + item.split() + words("en", 9)))
        add(" ".join(words("en", 7) + own))
        add(" ".join(words("en", 20) + item.split()[:14] + words("en", 20)))  # less than the item: stays
    add(None), add(""), add("12 34 !!")
    add(plain("en"), doc_id=None)
    add(" ".join(words("en", 25)), doc_id=70)
    folder = tmp_path_factory.mktemp("planted")
    docs = frame(rows)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), [r.asDict() for r in docs.collect()], items


def counted(rows):
    return Counter((r["doc_id"], r["text"], r["source"], r["n_chars"]) for r in rows)


def test_every_stage_and_the_run(spark, planted):
    folder, rows, items = planted
    plain = [
        identified, without_recurring_lines, one_of_each_class, lambda docs: without_leaks(docs, items), mixed,
    ]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for (name, stage), own in zip(corpus_pipeline.STAGES, plain, strict=True):
        before = len(rows)
        rows = list(own(rows))
        docs = spark.createDataFrame([tuple(r) for r in stage(spark, docs, folder).collect()], docs.schema)
        assert counted(r.asDict() for r in docs.collect()) == counted(rows), name
        assert name == "line_templates" or len(rows) != before, name  # the planted rows test every stage
    assert counted(r.asDict() for r in corpus_pipeline.run(spark, folder).collect()) == counted(rows)


def test_language_shares_by_exact_sets(spark, planted):
    folder, rows, _ = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    sets = learned(rows)
    got = language.predict(docs, language.train_on(docs)).select("text", "lang_pred", "score").collect()
    assert len(got) == len(rows)
    for r in got:
        own = shares(sets, r["text"])
        if not any(c.isalpha() for c in r["text"] or ""):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:  # the filters admit few foreign n-grams by chance
            assert abs(r["score"] - max(own.values())) < 0.005
            assert own[r["lang_pred"]] > max(own.values()) - 0.005
