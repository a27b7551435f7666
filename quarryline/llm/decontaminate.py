"""Benchmark decontamination by item-sized windows.

A window has as many words as a benchmark item.  Windows that hold enough of the
five-word shingles of items of their size are fingerprinted by SimHash; blocks of
the fingerprint, with every value within BLOCK_RADIUS bits, are an index that
finds all item fingerprints within RADIUS bits.  Candidates are verified by the
exact similarity of their shingles, weighted by how often each occurs.

The shingle gate loses nothing: a similarity of LEAST needs LEAST of the item's
shingles in the window.  Documents hold the same windows over and over, so
windows are compared once for each content.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarryline.llm.wordhash import SHINGLE_WORDS, mixed, shingles_of, text_blocks, words_of
from quarryline.session import pin

LEAST = 0.8
# 128 bits; at a similarity of 0.8 the distance is 19 bits with a deviation of 4.
RADIUS = 34
BLOCK_BITS = (11,) * 8 + (10,) * 4
BLOCK_RADIUS = RADIUS // len(BLOCK_BITS)
# Shingles of the benchmark that a task holds; a larger benchmark is run in parts.
GATE_SHINGLES = 2_000_000


def simhash(shingles: np.ndarray) -> tuple[int, int]:
    """The 128 sign bits of the sum of the shingles' bits, as two signed 64-bit numbers."""
    halves = []
    for salt in (0, 0x5851F42D4C957F2D):
        bits = np.unpackbits(mixed(shingles ^ np.uint64(salt)).view(np.uint8).reshape(-1, 8), axis=1)
        sign = bits.sum(0, dtype=np.int64) * 2 > len(shingles)
        halves.append(int(np.packbits(sign).view(np.int64)[0]))
    return halves[0], halves[1]


def weighted_similarity(one: np.ndarray, other: np.ndarray) -> float:
    """Common shingles over all shingles, each as often as it occurs."""
    a, n_a = np.unique(one, return_counts=True)
    b, n_b = np.unique(other, return_counts=True)
    _, at_a, at_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    common = int(np.minimum(n_a[at_a], n_b[at_b]).sum())
    total = len(one) + len(other) - common
    return common / total if total else 0.0


def benchmark_items(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, n, shingles, f0, f1) of the items that have words."""

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row, data, offsets in text_blocks(batch.column(1)):
                words = words_of(data, offsets)
                shingles, first = shingles_of(words)
                for k in np.flatnonzero(np.diff(words.first)):
                    own = shingles[first[k] : first[k + 1]]
                    rows.append((batch.column(0)[row + k].as_py(), int(words.first[k + 1] - words.first[k]), own.view(np.int64), *simhash(own)))
            yield _batch(rows, ["item", "n", "shingles", "f0", "f1"], item_type)

    kind = items.schema[id_col].dataType
    item_type = pa.string() if kind.simpleString() == "string" else pa.int64()
    stored = "string" if kind.simpleString() == "string" else "long"
    named = items.select(F.col(id_col).cast(stored), text_col)
    return named.mapInArrow(prepare, f"item {stored}, n int, shingles array<long>, f0 long, f1 long")


def _batch(rows: list[tuple], names: list[str], first: pa.DataType) -> pa.RecordBatch:
    kinds = {"n": pa.int32(), "shingles": pa.list_(pa.int64()), "keys": pa.list_(pa.int64())}
    columns = list(zip(*rows)) if rows else [()] * len(names)
    arrays = [pa.array(list(c), first if k == 0 else kinds.get(x, pa.int64())) for k, (x, c) in enumerate(zip(names, columns))]
    return pa.RecordBatch.from_arrays(arrays, names)


class _Gate:
    """Which sizes of items each benchmark shingle belongs to."""

    def __init__(self, sizes: np.ndarray, shingles: np.ndarray):
        pairs = np.unique(np.stack([shingles, sizes.astype(np.uint64)], 1), axis=0)
        self.shingles, self.sizes = pairs[:, 0].copy(), pairs[:, 1].astype(np.int64)

    def hits(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, sizes): each place once for each size its shingle belongs to."""
        if not len(self.shingles):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        low = np.searchsorted(self.shingles, shingles)
        found = np.flatnonzero(self.shingles[np.minimum(low, len(self.shingles) - 1)] == shingles)
        low = low[found]
        counts = np.searchsorted(self.shingles, shingles[found], "right") - low
        inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        return np.repeat(found, counts), self.sizes[np.repeat(low, counts) + inner]


def _window_starts(places: np.ndarray, n_shingles: int) -> np.ndarray:
    """Starts of all stretches of ``n_shingles`` places with enough hits among them."""
    wanted = max(1, int(np.ceil(LEAST * n_shingles - 1e-9)))
    if len(places) < wanted:
        return np.zeros(0, np.int64)
    low = places[wanted - 1 :] - n_shingles + 1
    high = places[: len(places) - wanted + 1]
    room = np.maximum(high - low + 1, 0)
    inner = np.arange(room.sum()) - np.repeat(np.cumsum(room) - room, room)
    return np.unique(np.repeat(low, room) + inner)


def _windows(gate: _Gate, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(text, item size, shingles) of the windows worth a fingerprint."""
    words = words_of(data, offsets)
    shingles, first = shingles_of(words)
    places, sizes = gate.hits(shingles)
    if not len(places):
        return
    text = np.searchsorted(first, places, "right") - 1
    order = np.lexsort((places, text, sizes))
    places, sizes, text = places[order], sizes[order], text[order]
    edges = np.flatnonzero(np.diff(sizes) | np.diff(text)) + 1
    for group in np.split(np.arange(len(places)), edges):
        k, n = int(text[group[0]]), int(sizes[group[0]])
        n_shingles = max(1, n - SHINGLE_WORDS + 1)
        for start in _window_starts(places[group], n_shingles):
            own = shingles[max(start, first[k]) : min(start + n_shingles, first[k + 1])]
            yield k, n, own


def _hits(docs: DataFrame, gate_rows: list, id_col: str, text_col: str) -> DataFrame:
    """Rows of two kinds: (id, keys) for a document with windows, and once in a
    batch for a window content (its key, n, shingles, f0, f1)."""
    sizes = np.array([r["n"] for r in gate_rows for _ in r["shingles"]], np.int64)
    values = np.array([s for r in gate_rows for s in r["shingles"]], np.int64).view(np.uint64)
    gate = _Gate(sizes, values)
    id_type = docs.schema[id_col].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told: set[int] = set()
            ids, keys, ns, contents, f0s, f1s = [], [], [], [], [], []
            for row, data, offsets in text_blocks(batch.column(1)):
                of: dict[int, list[int]] = {}
                for k, n, own in _windows(gate, data, offsets):
                    order = np.arange(1, len(own) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                    key = int(mixed(np.array([mixed(own ^ mixed(order)).sum(dtype=np.uint64) ^ np.uint64(n)])).view(np.int64)[0])
                    of.setdefault(row + k, []).append(key)
                    if key not in told:
                        told.add(key)
                        f0, f1 = simhash(own)
                        ids.append(None), keys.append([key]), ns.append(n), contents.append(own.view(np.int64)), f0s.append(f0), f1s.append(f1)
                for at, found in of.items():
                    ids.append(at), keys.append(list(dict.fromkeys(found))), ns.append(None), contents.append(None), f0s.append(None), f1s.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(ids, pa.int64())), pa.array(keys, pa.list_(pa.int64())), pa.array(ns, pa.int32()),
                 pa.array(contents, pa.list_(pa.int64())), pa.array(f0s, pa.int64()), pa.array(f1s, pa.int64())],
                ["id", "keys", "n", "shingles", "f0", "f1"],
            )

    return docs.select(id_col, text_col).mapInArrow(find, f"id {id_type}, keys array<long>, n int, shingles array<long>, f0 long, f1 long")


def _blocks(rows: DataFrame, near: bool) -> DataFrame:
    """A row for each block of the fingerprint; with ``near`` for each value within BLOCK_RADIUS bits of it."""
    parts, low = [], 0
    for k, width in enumerate(BLOCK_BITS):
        half, shift = ("f0", low) if low + width <= 64 else ("f1", max(low - 64, 0))
        if low < 64 < low + width:  # the block that lies across both halves
            value = F.shiftrightunsigned("f0", low).bitwiseOR(F.shiftleft("f1", 64 - low)).bitwiseAND((1 << width) - 1)
        else:
            value = F.shiftrightunsigned(half, shift).bitwiseAND((1 << width) - 1)
        flips = _flips(width) if near else [0]
        values = F.transform(F.array(*[F.lit(x).cast("long") for x in flips]), lambda m, v=value: v.bitwiseXOR(m))
        parts.append(F.struct(F.lit(k).alias("block"), values.alias("values")))
        low += width
    spread = rows.select("*", F.explode(F.array(*parts)).alias("b"))
    return spread.select(*rows.columns, F.col("b.block").alias("block"), F.explode("b.values").alias("value"))


def _flips(width: int) -> list[int]:
    """All masks of ``width`` bits with at most BLOCK_RADIUS set."""
    masks = {0}
    for _ in range(BLOCK_RADIUS):
        masks |= {m | (1 << k) for m in masks for k in range(width)}
    return sorted(masks)


def _similarity() -> Column:
    @F.pandas_udf("double")
    def similarity(one, other):
        import pandas as pd

        return pd.Series([weighted_similarity(np.asarray(a), np.asarray(b)) for a, b in zip(one, other)])

    return similarity


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """(id, item, similarity) for each document and each item that a window of it resembles by LEAST or more.

    Window and item are compared at the item's size in words; a window may be cut
    short by the start or the end of its text, and an item of fewer than five words, which has no
    shingle of five, matches only a text of its words.  Items without words and documents without words
    match nothing; null texts count as empty; repeated items are items of their
    own, rows that share an id are one document, null ids come out as null.  Empty
    tables give no rows.  A benchmark of more than GATE_SHINGLES shingles is run in
    parts, each against all documents.
    """
    items = pin(benchmark_items(benchmark, item_col, item_text_col).dropDuplicates(["item", "f0", "f1", "n"]))
    total = items.agg(F.sum(F.size("shingles"))).first()[0] or 0
    parts = max(1, -(-total // GATE_SHINGLES))
    found = []
    for part in range(parts):
        own = items.where(F.pmod(F.xxhash64("item"), F.lit(parts)) == part) if parts > 1 else items
        found.append(_matches(pin(_hits(docs, own.select("n", "shingles").collect(), id_col, text_col)), own))
    matches = reduce(DataFrame.unionAll, found)
    return matches.groupBy(F.col("id").alias(id_col), F.col("item").alias(item_col)).agg(F.max("similarity").alias("similarity"))


def _matches(hits: DataFrame, items: DataFrame) -> DataFrame:
    windows = hits.where("n is not null").select(F.col("keys")[0].alias("key"), "n", "shingles", "f0", "f1").dropDuplicates(["key"])
    index = _blocks(items.select("item", "n", "f0", "f1"), near=True)
    probes = _blocks(windows.select("key", "n", "f0", "f1"), near=False)
    w, i = probes.alias("w"), index.alias("i")
    near = w.join(i, (F.col("w.n") == F.col("i.n")) & (F.col("w.block") == F.col("i.block")) & (F.col("w.value") == F.col("i.value")))
    distance = F.bit_count(F.col("w.f0").bitwiseXOR(F.col("i.f0"))) + F.bit_count(F.col("w.f1").bitwiseXOR(F.col("i.f1")))
    pairs = near.where(distance <= RADIUS).select("w.key", "i.item", "i.f0", "i.f1", "i.n").distinct()
    sides = pairs.join(windows.select("key", F.col("shingles").alias("own")), "key")
    sides = sides.join(items.select("item", "f0", "f1", "n", "shingles"), ["item", "f0", "f1", "n"])
    verified = sides.select("key", "item", _similarity()(F.col("own"), F.col("shingles")).alias("similarity")).where(F.col("similarity") >= LEAST)
    holders = hits.where("n is null").select("id", F.explode("keys").alias("key"))
    return holders.join(verified, "key").select("id", "item", "similarity")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that resemble no benchmark item; rows without an id stay."""
    leaks = contaminated(docs, benchmark, id_col, text_col).select(F.col(id_col).alias("_ql_leak")).where("_ql_leak is not null").distinct()
    return docs.join(leaks, docs[id_col] == F.col("_ql_leak"), "left_anti")
