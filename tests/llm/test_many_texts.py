"""Operators that compare or weigh texts, against brute force."""

import random
import re
import time
from collections import Counter

import numpy as np
from conftest import TINY
from llm.conftest import ODD

import corpus_pipeline
from quarryline.llm import components, decontaminate, jaccard_join, line_templates, mixing, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def shingles(text):
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")]
    return Counter(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else Counter()


def similar(a, b):
    return sum((a & b).values()) / sum((a | b).values())


def prose(rng, n):
    return [rng.choice("abcdefghij") + rng.choice("klmnopqrst") + rng.choice("uvwxyz") for _ in range(n)]


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = "edit" + str(rng.randrange(10**6))
    return words


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(k, k + 1) for k in range(400, 440)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        a, b = root(u), root(v)
        parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["least"] for r in components.least_of_component(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: root(x) for x in parent if root(x) != x}


def test_lines_dropped_from_texts_of_many_lines(frame):
    rng = random.Random(21)
    shared = [" ".join(prose(rng, 6)) for _ in range(50_000)]
    own = [" ".join(prose(rng, 6)) for _ in range(50_000)]
    mixed = [line for pair in zip(shared, own) for line in pair]
    rows = [(1, "\n".join(shared)), (2, "\n".join(mixed)), (3, "\n".join(["", shared[0], "", "a", shared[1]]))]
    started = time.monotonic()
    got = {r["doc_id"]: r for r in line_templates.drop_recurring_lines(frame(rows)).collect()}
    assert time.monotonic() - started < 60
    assert got[1]["text"] == rows[0][1] and got[2]["text"] == "\n".join(own) and got[3]["text"] == "\n\na"
    assert (got[2]["_ql_n_lines"], got[2]["_ql_n_dropped"]) == (100_000, 50_000)


def test_texts_without_ids_are_linked(frame):
    rng = random.Random(22)
    base = prose(rng, 60)
    near = [*base[:58], "other", "end"]
    far = prose(rng, 60)
    rows = [(None, " ".join(base)), (5, " ".join(near)), (None, " ".join(far)), (None, " ".join([*far[:59], "z"])), (None, " ".join(base))]
    got = sorted((r["doc_id"] or 0, r["class_id"] or 0, r["n_links"], r["n_texts"], r["n_copies"]) for r in jaccard_join.near_duplicates(frame(rows)).collect())
    assert got == [(0, 0, 1, 1, 1), (0, 0, 1, 1, 1), (0, 5, 2, 1, 2), (0, 5, 2, 1, 2), (5, 5, 2, 1, 1)]
    kept = [(r["doc_id"], r["text"]) for r in jaccard_join.keep_one_of_each_class(frame(rows)).collect()]
    assert (5, rows[1][1]) in kept and len(kept) == 2 and {t for _, t in kept} & {rows[2][1], rows[3][1]}


def test_only_rows_of_a_class_go(frame):
    """Unrelated texts of one id stay, as do texts without words; copies do not."""
    rng = random.Random(23)
    one, other, third = (" ".join(prose(rng, 40)) for _ in range(3))
    rows = [(1, one), (1, other), (2, one), (2, third), (3, third), (3, third), (4, ""), (4, ""), (None, None), (7, one), (6, other)]
    kept = sorted((r["doc_id"] or 0, r["text"] or "") for r in jaccard_join.keep_one_of_each_class(frame(rows)).collect())
    assert kept == sorted([(1, one), (1, other), (2, third), (4, ""), (4, ""), (0, "")])
    same = [(9, one), (9, one), (9, one)]
    assert [(r["doc_id"], r["text"]) for r in jaccard_join.keep_one_of_each_class(frame(same)).collect()] == [(9, one)]


def test_near_duplicates(frame, monkeypatch):
    rng = random.Random(4)
    rows, n = [], 0
    for size in (1, 1, 1, 2, 3, 5, 40):
        base = prose(rng, 90)
        for _ in range(size):
            rows.append((n, " ".join(edited(rng, base, rng.randrange(0, 4)))))
            n += 1
    rows += [(900 + k, rows[-1][1]) for k in range(30)] + [(950, "Two Words"), (951, "two words"), (952, "..."), (953, "..."), (954, None)]
    sets = {i: set(shingles(t)) for i, t in rows}
    links = {i: [j for j in sets if j != i and sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9] for i in sets}
    least = {i: i for i in sets}
    for _ in range(len(sets)):
        least = {i: min([least[i], *[least[j] for j in links[i]]]) for i in sets}
    for block in (jaccard_join.BLOCK_SHINGLES, 700):  # 700: the large group is cut into blocks
        monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", block)
        got = {r["doc_id"]: r for r in jaccard_join.near_duplicates(frame(rows)).collect()}
        assert {i: r["n_links"] for i, r in got.items()} == {i: len(x) for i, x in links.items()}
        assert {i: r["class_id"] for i, r in got.items()} == least
    kept = jaccard_join.keep_one_of_each_class(frame(rows + rows[:1]))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(least.values())) and "line" in kept.columns
    assert jaccard_join.near_duplicates(frame(ODD)).count() == len(ODD) and jaccard_join.near_duplicates(frame([])).count() == 0


def test_bayes_bounds_keep_similar_pairs():
    fewest = jaccard_join.least_matches()
    rng = np.random.default_rng(1)
    for step, m in enumerate(fewest):
        n = (step + 1) * jaccard_join.CHUNK
        assert (rng.binomial(n, 0.8, 100_000) < m).mean() < 1e-3
    assert fewest[-1] > 0.55 * jaccard_join.BANDS * jaccard_join.ROWS


def test_contaminated(spark, frame):
    rng = random.Random(6)
    items = [" ".join(prose(rng, rng.randint(12, 60))) for _ in range(12)] + ["one two three", "", None]
    rows = []
    for k in range(160):
        words = prose(rng, rng.randint(0, 150))
        if k % 3 == 0:
            item = rng.choice(items[:12]).split()
            at = rng.randint(0, len(words))
            words = words[:at] + edited(rng, item, rng.randrange(0, 3)) + words[at:]
        rows.append((k, " ".join(words)))
    rows += [(500, "x one two three y"), (501, "One-two THREE"), (502, items[0]), (502, items[0]), (None, items[1]), (503, None)]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    want = set()
    for doc, text in rows:
        words = WORD.findall(text or "")
        for item, body in enumerate(items):
            size = len(WORD.findall(body or ""))
            # Windows may be cut short by the start or the end of the text.
            windows = [words[max(0, k) : k + size] for k in range(1 - size, len(words))] if size and words else []
            windows = [w for w in windows if len(w) >= 5 or w == words]
            if any(similar(shingles(" ".join(w)), shingles(body)) >= 0.8 for w in windows):
                want.add((doc, item))
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(frame(rows), benchmark).collect()}
    # An item under five words matches only texts that are as short.
    assert got == want
    kept = decontaminate.drop_contaminated(frame(rows), benchmark)
    assert {r["doc_id"] for r in kept.collect()} == {r[0] for r in rows} - {d for d, _ in got if d is not None}
    assert decontaminate.contaminated(frame([]), benchmark).count() == 0
    assert decontaminate.contaminated(frame(rows), benchmark.limit(0)).count() == 0
    assert decontaminate.contaminated(frame(ODD), benchmark).count() == 0


def test_benchmark_in_parts(spark, frame, monkeypatch):
    docs, benchmark = frame([(1, "a b c d e f g h"), (2, "k l m n o p q r")]), spark.createDataFrame(
        [(1, "b c d e f g"), (2, "k l m n o p q")], "item_id long, text string")
    monkeypatch.setattr(decontaminate, "GATE_SHINGLES", 2)
    assert sorted((r[0], r[1]) for r in decontaminate.contaminated(docs, benchmark).collect()) == [(1, 1), (2, 2)]


def templates(line):
    tokens = [line_templates.VARIABLE if re.search("[0-9]", t) else t for t in line.split(" ")]
    n = len(tokens)
    if n < line_templates.LEAST_TOKENS:
        return set()
    edges = [2 + max(n - 2, 0) * k // 5 for k in range(6)]
    out = {(n, -1, *tokens)}
    for k in range(5):
        width = edges[k + 1] - edges[k]
        if width > 0 and n - width >= line_templates.LEAST_TOKENS:
            out.add((n, k, *tokens[: edges[k]], *tokens[edges[k + 1] :]))
    return out


def test_line_templates(frame):
    rng = random.Random(8)
    shared = [" ".join(prose(rng, n)) for n in (3, 4, 9, 20, 60)] + ["user 17 logged in from 10.0.0.1 today", "é è  ü   x y z"]
    rows = []
    for k in range(60):
        lines = [" ".join(prose(rng, rng.randint(1, 12))) for _ in range(rng.randint(0, 4))]
        for line in rng.sample(shared, 3):
            words = line.split(" ")
            words[rng.randrange(len(words))] += rng.choice(["", "", "q", "7"])
            lines.insert(rng.randint(0, len(lines)), " ".join(words))
        rows.append((k, "\n".join(lines)))
    holders = {}
    for doc, text in rows:
        for line in text.split("\n"):
            for t in templates(line):
                holders.setdefault(t, set()).add(doc)
    got = {r["doc_id"]: r for r in line_templates.drop_recurring_lines(frame(rows)).collect()}
    for doc, text in rows:
        lines = text.split("\n")
        kept = [x for x in lines if not any(min(holders[t]) < doc for t in templates(x))]
        assert got[doc]["text"] == "\n".join(kept) and got[doc]["_ql_n_dropped"] == len(lines) - len(kept)
    thrice = line_templates.recurring_templates(frame(rows), least=3).count()
    assert thrice == sum(len(x) >= 3 for x in holders.values())
    odd = line_templates.drop_recurring_lines(frame(ODD)).collect()
    assert Counter((r["doc_id"], r["text"]) for r in odd) == Counter((i, t) for i, t, *_ in ODD)
    assert line_templates.drop_recurring_lines(frame([])).count() == 0


def test_short_recurring_lines(spark, frame):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").collect()
    left = {r["doc_id"]: r["text"] for r in queries.op2_line_templates(spark, "/root/testdata/sf0.01").collect()}
    seen = set()
    for r in docs:
        lines = (r["text"] or "").split("\n")
        assert not [x for x in (left[r["doc_id"]] or "").split("\n") if x in seen]
        seen |= {x for x in lines if re.search(r"[^\W\d_]", re.sub(r"\S*\d\S*", "", x))}
    rows = [(1, "Of.\n12\nPage 3\nx"), (2, "Of.\n12\nPage 47\n\nof."), (3, "Of.\nOf. it\n\n7 --\nPage 1 a"), (None, "Of.\nx")]
    got = line_templates.drop_recurring_lines(frame(rows), short_lines=True).collect()
    assert {(r["doc_id"], r["text"], r["_ql_n_dropped"]) for r in got} == {
        (1, rows[0][1], 0), (2, "12\n\nof.", 2), (3, "Of. it\n\n7 --\nPage 1 a", 1), (None, rows[3][1], 0)}


def test_mix(spark, frame):
    rng = random.Random(9)
    rows = [(k, " ".join(["w"] * rng.randint(0, 40)), "en", s) for k, s in enumerate(["a"] * 300 + ["b"] * 80 + ["c"] * 60 + [None] * 30 + ["e"] * 5)]
    sizes = mixing.sizes_of(frame(rows))
    got = mixing.mix_copies(sizes).collect()
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix_copies(sizes.repartition(5)).collect()))
    total = Counter()
    for _, text, _, s in rows:
        total[s] += len(text.split())
    order = sorted((s for s in total if s is not None)) + [None]
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, left = {}, 1.5 * sum(total.values())
    open_ = set(order)
    while True:
        share = {s: left * weights[s] / sum(weights[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > 2 * total[s]}
        if not full:
            target |= share
            break
        target |= {s: 2 * total[s] for s in full}
        left -= sum(2 * total[s] for s in full)
        open_ -= full
    taken = Counter()
    for r in got:
        assert r["source_size"] == total[r["source"]] and abs(r["target"] - target[r["source"]]) < 1e-6
        assert 0 <= r["copies"] <= 2
        taken[r["source"]] += r["copies"] * r["size"]
    assert all(abs(taken[s] - target[s]) <= 20 for s in order)
    mixed = mixing.mixed_documents(frame(rows))
    assert mixed.count() == sum(r["copies"] for r in got) and mixed.columns == frame(rows).columns
    assert mixing.mix_copies(mixing.sizes_of(frame([]))).count() == 0 and mixing.mix_copies(mixing.sizes_of(frame(ODD))).count() == len(ODD)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before, docs = docs, stage(spark, docs, TINY)
        assert docs.columns == before.columns
        if k < 4:
            ids = {r[0] for r in docs.select("doc_id").collect()}
            assert ids <= {r[0] for r in before.select("doc_id").collect()} and docs.count() == len(ids)
    assert docs.count() > 100
    run = corpus_pipeline.run(spark, TINY)
    key = lambda df: Counter(tuple(r) for r in df.select("doc_id", "text").collect())
    assert key(run) == key(docs)
