"""Conversation repair against a search over all edits."""

import hashlib
import random
import re
import zlib
from functools import lru_cache
from itertools import pairwise

import pytest
from conftest import TINY

from quarryline.llm import conversation_repair, queries

ROLE_OF = {"u": "user", "a": "assistant"}
PATTERN = re.compile("(s?(ua)+)?")
BEGINS = re.compile("(s?(ua)*u?)")


def cheapest(rows):
    """(cost, letters, repaired rows) over (role, text, must go, truncated): every edit of
    every row, from the end, the written roles checked by the pattern itself."""

    @lru_cache(None)
    def best(i, written, inserted):
        found = []
        if i == len(rows) and PATTERN.fullmatch(written):
            found.append((0, "", ()))

        def add(cost, letter, row, at, n):
            now = written + (row[0][:1] if row else "")
            if BEGINS.fullmatch(now):
                # Only the start and the last role matter for what may follow.
                now = now if len(now) < 3 else "ua" if now[-1] == "a" else "uau"
                rest = best(at, now, n)
                if rest:
                    found.append((cost + rest[0], letter + rest[1], ((row,) if row else ()) + rest[2]))

        if i < len(rows):
            role, text, must_go, truncated = rows[i]
            add(2, "D", None, i + 1, 0)
            if not must_go:
                add(5 * truncated, "K", (role, text), i + 1, 0)
                for name in ROLE_OF.values():
                    add(1 + 5 * truncated, "R", (name, text), i + 1, 0)
        if inserted < 3:
            for name in ROLE_OF.values():
                add(5, "I", (name, ""), i, inserted + 1)
        return min(found, key=lambda f: f[:2]) if found else None

    return best(0, "", 0)


def random_rows(rng):
    n, p = rng.choice([0, 1, 2, 3, 5, 8, 14]), rng.random()
    return [
        (rng.choice(["user", "assistant", "system", "tool", "", " "]) if rng.random() < p else ("user", "assistant")[i % 2],
         f"t{i}", rng.random() < 0.2 * p, rng.random() < 0.4 * p)
        for i in range(n)
    ]


def test_search():
    rng = random.Random(3)
    for _ in range(2_000):
        rows, got = random_rows(rng), []
        search = conversation_repair.Viterbi(lambda *edit, got=got: got.append(edit))
        for row in rows:
            search.row(*row)
        cost = search.end()
        assert (cost, "".join(e[0] for e in got), tuple(e[1:] for e in got if e[1] is not None)) == cheapest(rows)


def test_edits_go_out_as_survivors_meet():
    rng, got = random.Random(4), []
    search = conversation_repair.Viterbi(lambda *edit: got.append(edit))
    longest = 0
    for _ in range(50_000):
        search.row(rng.choice(["user", "assistant"]), "t", rng.random() < 0.05, rng.random() < 0.05)
        longest = max(longest, max(node.length for _, node in search.survivors.values()) - search.root.length)
    assert longest < 200 and len(got) > 49_000


@pytest.mark.parametrize("row", [("user", "x", False, False), ("system", "x", False, True), ("user", "", True, False)])
def test_long_conversations_of_one_kind(row):
    got = []
    search = conversation_repair.Viterbi(lambda *edit: got.append(edit))
    for _ in range(60_000):
        search.row(*row)
    search.end()
    assert len(got) >= 60_000


def damaged(rows):
    out = []
    for conv_id, turn, role, text in rows:
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fault:
            row = (conv_id, turn, "user" if fault == 4 else role, "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text)
            out += [row] * (2 if fault == 3 else 1)
    return out


def report(rows):
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    seen, marked, counts = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
    for _, _, role, text in rows:
        shown = text.strip("\x20\x09\x0a\x0b\x0c\x0d")
        fault = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else None
        seen.add((role, text))
        counts.update({fault: counts[fault] + 1} if fault else {})
        marked.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
    turns = {r[1] for r in rows} - {None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in pairwise(rows))
    cost, audit, kept = cheapest(marked)
    digest = hashlib.sha256("\n".join(f"{role}:{text}" for role, text in kept).encode()).hexdigest()
    return gaps, *counts.values(), illegal, cost, audit, digest


def check(spark, got, rows):
    want = {conv_id: report([r for r in damaged(rows) if r[0] == conv_id]) for conv_id in {r[0] for r in rows}}
    got = [tuple(r) for r in got.collect()]
    assert len(got) == len(want)
    assert {r[0]: r[1:] for r in got} == want


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{TINY}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    check(spark, queries.QUERIES["op13_conversation_repair"](spark, TINY), rows)


SCHEMA = "conv_id long, turn long, role string, text string, audit string, cost int"


def test_odd_rows(spark):
    rng = random.Random(8)
    texts = ["Fine.", "cut", "", " \t\n", "Same.", "é!", None, "two\nlines? ", "a" * 50_000 + "."]
    rows = [
        (rng.choice([None, 1, 2, 3, 4]), rng.choice([None, *range(12)]), rng.choice(["user", "assistant", "system", "", None, "sage", "Üser"]), rng.choice(texts))
        for _ in range(90)
    ]
    rows += [(50, 4, "user", "Hi."), (51, None, None, None), (1, 2, "user", "Same."), (1, 2, "user", "Same.")]
    df = spark.createDataFrame([(*r, "a", 1) for r in rows], SCHEMA).repartition(3)
    check(spark, conversation_repair.repair_all(df, conversation_repair.damaged(df)), rows)


def test_repaired_rows(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Yes."), (1, 2, "user", ""), (2, 0, "system", "Be."), (2, 1, "user", "Go.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted(tuple(r) for r in conversation_repair.repaired(df).collect())
    assert got == [(1, 0, "K", "user", "Hi."), (1, 1, "R", "assistant", "Yes."), (2, 0, "R", "user", "Be."), (2, 1, "R", "assistant", "Go.")]
    empty = df.limit(0)
    assert conversation_repair.repaired(empty).count() == 0
    assert conversation_repair.repair_all(empty, empty).count() == 0
