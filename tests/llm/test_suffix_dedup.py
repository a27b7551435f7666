"""Suffix order by induction and removal of repeated strings, against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm.conftest import ODD

from quarryline.llm import induced, suffix_dedup

W = suffix_dedup.WINDOW


def order_of(text, depth):
    order = sorted(range(len(text)), key=lambda i: text[i:])
    shared = [0]
    for a, b in zip(order, order[1:], strict=False):
        k = 0
        while k < depth and text[a + k] == text[b + k]:
            k += 1
        shared.append(k)
    return order, shared


@pytest.mark.parametrize("resident", [10, 10**8], ids=["files", "memory"])
def test_suffix_order(monkeypatch, resident):
    rng = random.Random(1)
    for _ in range(300):
        monkeypatch.setattr(induced, "NAMES_REPEAT", rng.choice([1, 2, 64]))
        monkeypatch.setattr(induced, "CHUNK", rng.choice([1, 3, 65_536]))
        kinds, n = rng.choice([1, 2, 3, 200]), rng.choice([0, 1, 2, 10, 60, 200])
        text = [rng.randrange(1, kinds + 1) for _ in range(n)]
        if rng.random() < 0.3:
            text = (text[: max(1, n // 10)] * 12)[:n]
        text.append(0)
        order, shared = order_of(text, 1000)
        with induced.Scratch(resident) as scratch:
            got = induced.suffix_order(np.array(text, np.int32), 1000, scratch)
        assert ([*got[0]], [*got[1]]) == (order, shared)
        # To a depth, suffixes alike so far may stand in any order.
        with induced.Scratch(resident) as scratch:
            places, shared_to = induced.suffix_order(np.array(text, np.int32), 4, scratch)
        assert [text[i : i + 4] for i in places] == [text[i : i + 4] for i in order]
        assert [*shared_to] == [min(s, 4) for s in shared]


def test_spill_files_go(monkeypatch, tmp_path):
    monkeypatch.setenv("SPARK_LOCAL_DIRS", str(tmp_path))
    with induced.Scratch(10) as scratch:
        induced.suffix_order(np.array([*([3, 1, 2] * 40), 0], np.int32), 50, scratch)
        assert scratch.files >= 4 and any(tmp_path.iterdir())
    assert not any(tmp_path.iterdir())


def left_of(texts):
    """Per text: bytes, bytes removed, runs removed, bytes left."""
    raws = [(t or "").encode() for t in texts]
    met = Counter(r[i : i + W] for r in raws for i in range(len(r) - W + 1))
    out = []
    for raw in raws:
        gone = bytearray(len(raw))
        for i in range(len(raw) - W + 1):
            if met[raw[i : i + W]] > 1:
                gone[i : i + W] = b"\1" * W
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(raw), sum(gone), runs, bytes(b for b, g in zip(raw, gone, strict=True) if not g)))
    return out


def planted():
    rng = random.Random(5)

    def words(n):
        return "".join(rng.choice("abcdefghijéü ") for _ in range(n))

    passage, edge = words(700), words(360)
    texts = [words(rng.randrange(0, 1500)) for _ in range(20)]
    texts += [words(rng.randrange(0, 300)) + passage + words(rng.randrange(0, 300)) for _ in range(15)]
    texts += [words(50) + passage[:390].encode().decode() + words(50) for _ in range(3)]  # a part only
    texts += [words(40) + edge + words(500) for _ in range(4)]
    once = words(900)
    texts += [once, once, words(5) + once + once, None, "", "short", "x" * 900, "y" * W, "ab" * 300, "z" * (W + 1)]
    return texts + ["z" * (W - 1), words(W), "é" * 500]


@pytest.mark.parametrize("most, widths", [(5_000, (75, 1)), (1, (75, 19, 5, 1)), (3, (75, 1)), (1, (1,))])
def test_drop_repeats(spark, monkeypatch, most, widths):
    """Contents in shards, and those of a hash divided by cores of several levels."""
    monkeypatch.setattr(suffix_dedup, "MOST_CONTENTS", most)
    monkeypatch.setattr(suffix_dedup, "CORE_WIDTHS", widths)
    texts = planted()
    rows = [(i // 2, t, b"k", 1, "h") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept binary, start int, hash string")
    docs = docs.repartition(3)
    got = suffix_dedup.drop_repeats(docs)
    assert got.columns[:4] == ["doc_id", "kept", "start", "hash"]
    got = sorted((r["doc_id"], r["_ql_n_bytes"], r["_ql_n_removed"], r["_ql_n_spans"], bytes(r["_ql_kept"]), r["_ql_kept_sha256"]) for r in got.collect())
    want = sorted((i // 2, *row, hashlib.sha256(row[3]).hexdigest()) for i, row in enumerate(left_of(texts)))
    assert got == want
    assert sum(row[2] > 0 for row in want) > 20


def test_odd_rows_and_an_empty_table(frame):
    got = suffix_dedup.drop_repeats(frame(ODD), keep_bytes=False).collect()
    left = {r["doc_id"]: (r["_ql_n_bytes"], r["_ql_n_removed"], r["_ql_n_spans"]) for r in got}
    assert len(got) == len(ODD) and left[1] == left[2] == (0, 0, 0) and left[4] == (50, 0, 0)
    assert left[5] == (150_000, 150_000, 1) and left[6] == (200_000, 200_000, 1)
    assert suffix_dedup.drop_repeats(frame(ODD).limit(0)).count() == 0


def test_long_texts_and_hashes_of_many_bytes(spark, monkeypatch):
    """Texts in parts, and hashes divided for their bytes: stretches that repeat themselves."""
    monkeypatch.setattr(suffix_dedup, "HASHED_BYTES", 700)
    monkeypatch.setattr(suffix_dedup, "HASH_BYTES", 1_500)
    texts = planted() + [unit * n for unit in ("q", "uv", "é-", "xyz" * 67) for n in (410, 611, 2_003)] + ["pq" * 900 + "r" + "pq" * 700]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = suffix_dedup.drop_repeats(docs).orderBy("doc_id").collect()
    got = [(r["_ql_n_bytes"], r["_ql_n_removed"], r["_ql_n_spans"], bytes(r["_ql_kept"])) for r in got]
    assert got == left_of(texts)


def test_windows_of_a_stretch_that_repeats_itself():
    """As many rows as different windows and one for the run, not one for each window."""
    content = pa.table({"digest": [b"d"], "piece": [b"ab" * 5_000], "copies": [1]}).to_batches()
    rows = pa.Table.from_batches(suffix_dedup._single_windows(iter(content)))
    assert rows["start"].to_pylist() in ([0, 1, 0], [1, 0, 0]) and sum(rows["met"].to_pylist()) == 9_601
    assert rows["windows"].to_pylist() == [1, 1, 9_601]


def test_shards_keep_to_their_bytes(monkeypatch):
    """However many contents come at once, a shard is SHARD_BYTES at most or one hash."""
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 20_000)
    met = []
    monkeypatch.setattr(suffix_dedup, "repeats_in_shard", lambda t: met.append([t["hash"].to_pylist(), t["piece"].to_pylist()]))
    hashes = sorted([-5] * 70 + [k // 3 for k in range(600)] + [900] * 60)
    pieces = [bytes([k % 256]) * (400 + k % 300) for k in range(len(hashes))]
    for at_once in (7, 50, 10_000):
        met.clear()
        list(suffix_dedup._shards(iter(pa.table({"hash": hashes, "piece": pieces}).to_batches(at_once))))
        assert [h for shard in met for h in shard[0]] == hashes and [p for shard in met for p in shard[1]] == pieces
        assert all(len(set(shard[0])) == 1 or sum(map(len, shard[1])) <= 20_000 for shard in met)
        assert not any(a[0][-1] == b[0][0] for a, b in zip(met, met[1:], strict=False))
