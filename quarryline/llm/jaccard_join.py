"""N-gram Jaccard join with Bayesian pruning.

Texts are sets of five-word shingles.  Equal sets are one node.  MinHash bands
propose candidates; nodes joined by bands form candidate groups, and every pair
of a group is a candidate.  Pairs compare their MinHash values CHUNK at a time,
and are dropped when the posterior probability of reaching LEAST falls below
TOLERANCE; the pairs that remain are verified by their exact similarity.

Pairs never become rows.  A task holds the shingles of one bundle of small groups
or of two blocks of a large group, and gives a count of links and one tie for
each node.  Blocks are cut by the shingles they hold, so a large group costs
its square in arithmetic but no task and no table grows with that square.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarryline.llm.components import least_of_component
from quarryline.llm.wordhash import mixed, shingles_of, text_blocks, words_of
from quarryline.session import pin

LEAST = 0.8
# A pair of similarity 0.8 shares no band with probability (1 - 0.8**5)**32 = 3e-6.
BANDS, ROWS = 32, 5
CHUNK = 32
TOLERANCE = 1e-6
# Shingles of one bundle of groups, or of one block of a large group.
BLOCK_SHINGLES = 1_500_000
_FACTORS = mixed(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def minhashes(shingles: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Signatures, texts x hashes; every text must have a shingle."""
    out = np.empty((len(first) - 1, len(_FACTORS)), np.uint32)
    for k, factor in enumerate(_FACTORS):
        out[:, k] = np.minimum.reduceat(((shingles * factor) >> np.uint64(32)).astype(np.uint32), first[:-1])
    return out


def least_matches(least: float = LEAST, tolerance: float = TOLERANCE) -> list[int]:
    """For CHUNK, 2 CHUNK, ... compared values the fewest matches that a pair goes on with.

    With a uniform prior, m matches of n leave a Beta(m + 1, n - m + 1) posterior;
    the chance of a similarity of ``least`` or more is a binomial sum.
    """
    out = []
    for n in range(CHUNK, BANDS * ROWS + 1, CHUNK):
        chance, m = 0.0, -1
        while chance < tolerance:
            m += 1
            chance += math.comb(n + 1, m) * least**m * (1 - least) ** (n + 1 - m)
        out.append(m)
    return out


def _distinct(shingles: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of each text."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((shingles, text))
    shingles, text = shingles[order], text[order]
    keep = np.ones(len(shingles), bool)
    keep[1:] = (shingles[1:] != shingles[:-1]) | (text[1:] != text[:-1])
    counts = np.bincount(text[keep], minlength=len(first) - 1)
    return shingles[keep], np.concatenate([[0], np.cumsum(counts)])


def _sets(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, shingles, first, 128-bit names) of the texts that have words."""
    for row, data, offsets in text_blocks(batch.column(1)):
        shingles, first = _distinct(*shingles_of(words_of(data, offsets)))
        some = np.flatnonzero(np.diff(first))
        if not len(some):
            continue
        first = np.append(first[some], first[-1])
        sizes = np.diff(first).astype(np.uint64)
        one = mixed(np.add.reduceat(mixed(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5)), first[:-1]) + sizes)
        two = mixed(np.add.reduceat(mixed(shingles * np.uint64(0x9FB21C651E98DF25)), first[:-1]) ^ sizes)
        yield row + some, shingles, first, np.stack([one, two], 1)


def _binary(values: np.ndarray) -> pa.Array:
    """A 16-byte name for each row of two numbers."""
    return pa.array([x.tobytes() for x in np.ascontiguousarray(values).astype(">u8")], pa.binary())


def _nodes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, key, node, n, bands): a hash of a document's text, the name of its shingle set
    and its band hashes; the last three null without words."""
    id_type = docs.schema[id_col].dataType.simpleString()
    columns = np.arange(BANDS * ROWS).reshape(BANDS, ROWS)

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes: list[bytes | None] = [None] * batch.num_rows
            sizes: list[int] = [0] * batch.num_rows
            bands: list[np.ndarray | None] = [None] * batch.num_rows
            for rows, shingles, first, names in _sets(batch):
                signature = minhashes(shingles, first).astype(np.uint64)
                hashed = np.empty((len(rows), BANDS), np.uint64)
                for b in range(BANDS):
                    value = np.full(len(rows), b, np.uint64)
                    for c in columns[b]:
                        value = mixed(value * np.uint64(0x9E3779B97F4A7C15) + signature[:, c])
                    hashed[:, b] = value
                for at, node, size, own in zip(rows.tolist(), _binary(names).to_pylist(), np.diff(first).tolist(), hashed.view(np.int64)):
                    nodes[at], sizes[at], bands[at] = node, size, own
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(nodes, pa.binary()), pa.array(sizes, pa.int64()), pa.array(bands, pa.list_(pa.int64()))],
                ["id", "key", "node", "n", "bands"],
            )

    rows = docs.select(id_col, text_col, _text_key(text_col).alias("key"))
    return rows.mapInArrow(name, f"id {id_type}, key binary, node binary, n long, bands array<long>")


def _text_key(text_col: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit(""))))


def _candidate_groups(nodes: DataFrame) -> DataFrame:
    """(name, least): nodes that share bands, directly or through others; by the first half of their names."""
    banded = nodes.select(F.xxhash64("node").alias("name"), F.explode("bands").alias("band"))
    hubs = banded.groupBy("band").agg(F.min("name").alias("hub"), F.max("name").alias("top")).where("hub < top").select("band", "hub")
    edges = banded.join(hubs, "band").where("name != hub").select(F.col("name").alias("u"), F.col("hub").alias("v"))
    return least_of_component(edges).select(F.col("node").alias("name"), "least")


class Group:
    """The nodes of a group that one task holds: names, copies, shingles, signatures."""

    def __init__(self, frame: pd.DataFrame):
        frame = frame.drop_duplicates("node")
        self.nodes = list(frame["node"])
        self.copies = frame["copies"].to_numpy(np.int64)
        sets = [np.frombuffer(x, np.uint64) for x in frame["shingles"]]
        self.sizes = np.array([len(x) for x in sets], np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.sizes)])
        self.shingles = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        self.signatures = minhashes(self.shingles, self.first) if sets else np.zeros((0, BANDS * ROWS), np.uint32)


def _alive(one: np.ndarray, others: np.ndarray, fewest: list[int]) -> np.ndarray:
    """Which of ``others`` are not dropped against the signature ``one``."""
    alive = np.arange(len(others))
    matches = np.zeros(len(others), np.int64)
    for step, least in enumerate(fewest):
        part = slice(step * CHUNK, (step + 1) * CHUNK)
        matches = matches[: len(alive)] + (others[alive, part] == one[part]).sum(1)
        going = matches >= least
        alive, matches = alive[going], matches[going]
    return alive


def _links(a: Group, b: Group, same: bool, fewest: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """(place in a, places in b) of the links of each node of a; with ``same`` only later places."""
    # Only shingles that occur twice can be common to a pair.
    joined = np.concatenate([a.shingles, b.shingles]) if not same else a.shingles
    values, inverse, counts = np.unique(joined, return_inverse=True, return_counts=True)
    rank = np.cumsum(counts > 1) - 1
    ids = np.where(counts[inverse] > 1, rank[inverse], -1)
    width = int((counts > 1).sum())
    ids_a, ids_b = ids[: len(a.shingles)], ids[-len(b.shingles) :] if len(b.shingles) else ids[:0]
    row_b = np.repeat(np.arange(len(b.nodes)), b.sizes)
    shared = ids_b >= 0
    dense = None
    if len(b.nodes) > 16 and width * 4 * len(b.nodes) <= 64_000_000:
        dense = np.zeros((len(b.nodes), width), np.float32)
        dense[row_b[shared], ids_b[shared]] = 1
    mark = np.zeros(width, bool)
    for start in range(0, len(a.nodes), 256):
        rows = range(start, min(start + 256, len(a.nodes)))
        survivors = [_alive(a.signatures[i], b.signatures[i + 1 :] if same else b.signatures, fewest) + (i + 1 if same else 0) for i in rows]
        table = None
        if dense is not None and sum(map(len, survivors)) > 0:
            block = np.zeros((len(rows), width), np.float32)
            own = ids_a[a.first[start] : a.first[rows[-1] + 1]]
            place = np.repeat(np.arange(len(rows)), a.sizes[start : rows[-1] + 1])
            block[place[own >= 0], own[own >= 0]] = 1
            table = block @ dense.T
        for k, i in enumerate(rows):
            places = survivors[k]
            if not len(places):
                continue
            if table is not None:
                common = table[k, places].astype(np.int64)
            else:
                own = ids_a[a.first[i] : a.first[i + 1]]
                mark[own[own >= 0]] = True
                common = np.array([mark[x[x >= 0]].sum() for x in (ids_b[b.first[j] : b.first[j + 1]] for j in places)], np.int64)
                mark[:] = False
            total = a.sizes[i] + b.sizes[places] - common
            linked = places[common >= LEAST * total - 1e-9]
            if len(linked):
                yield i, linked


def _linked(a: Group, b: Group, same: bool, fewest: list[int]) -> Iterator[tuple[bytes, int, int, bytes]]:
    """(node, linked nodes, linked documents, least node tied to it here) of every node with a link."""
    names = a.nodes if same else a.nodes + b.nodes
    shift = 0 if same else len(a.nodes)
    nodes, documents = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
    label = np.arange(len(names))
    for i, places in _links(a, b, same, fewest):
        nodes[i] += len(places)
        documents[i] += b.copies[places].sum()
        nodes[places + shift] += 1
        documents[places + shift] += a.copies[i]
        touched = np.unique(np.append(label[places + shift], label[i]))
        if len(touched) > 1:
            label[np.isin(label, touched)] = touched[0]
    order: dict[int, bytes] = {}
    for k in np.flatnonzero(nodes):
        order[label[k]] = min(order.get(label[k], names[k]), names[k])
    for k in np.flatnonzero(nodes):
        yield names[k], int(nodes[k]), int(documents[k]), order[label[k]]


def _verified(members: DataFrame) -> DataFrame:
    """(node, n_nodes, n_documents, tied) for members (bundle, side, least, node, copies, shingles)."""
    fewest = least_matches()

    def verify(frame: pd.DataFrame) -> pd.DataFrame:
        rows: list[tuple] = []
        for _, group in frame.groupby("least", sort=False):
            if (group["side"] == 0).all():
                own = Group(group)
                rows += _linked(own, own, True, fewest)
            else:
                rows += _linked(Group(group[group["side"] == 1]), Group(group[group["side"] == 2]), False, fewest)
        return pd.DataFrame(rows, columns=["node", "n_nodes", "n_documents", "tied"])

    return members.groupBy("bundle", "side_a", "side_b").applyInPandas(verify, "node binary, n_nodes long, n_documents long, tied binary")


def _members(docs: DataFrame, chosen: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(least, node, copies, n, shingles) of one document for each node of a candidate group.

    A node that has an id is read by its least id, others by the hash of a text, each
    text once."""
    named = chosen.where("id is not null").drop("key")
    texts = docs.select(F.col(id_col).alias("id"), text_col).join(named, "id")
    rows = docs.where(F.col(id_col).isNull()).groupBy(_text_key(text_col).alias("key")).agg(F.first(text_col).alias(text_col))
    unnamed = rows.join(chosen.where("id is null"), "key").drop("key")
    texts = texts.unionByName(unnamed.select(*texts.columns))

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, shingles, first, names in _sets(batch):
                found = _binary(names).to_pylist()
                at = [k for k, r in enumerate(rows) if found[k] == batch.column(3)[int(r)].as_py()]
                taken = batch.select([2, 3, 4, 5]).take(pa.array([int(rows[k]) for k in at], pa.int64()))
                own = pa.array([shingles[first[k] : first[k + 1]].tobytes() for k in at], pa.binary())
                yield pa.RecordBatch.from_arrays([*taken.columns, own], ["least", "node", "copies", "n", "shingles"])

    return texts.select("id", text_col, "least", "node", "copies", "n").mapInArrow(
        load, "least long, node binary, copies long, n long, shingles binary"
    )


def _bundled(members: DataFrame, groups: DataFrame) -> DataFrame:
    """Members with the bundle they are compared in.

    ``groups`` has (least, total shingles, blocks).  Groups of one block share
    bundles of about BLOCK_SHINGLES; of larger ones each pair of blocks is a bundle.
    """
    small = groups.where("blocks = 1").agg(F.sum("total")).first()[0] or 0
    bundles = max(1, math.ceil(small / BLOCK_SHINGLES))
    joined = members.join(groups.select("least", "blocks"), "least")
    block = F.pmod(F.xxhash64(F.lit(1), "node"), F.col("blocks")).cast("int")
    one = F.col("blocks") == 1
    pairs = F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1))
    spread = joined.withColumn("block", block).select("*", pairs.alias("other"))
    return spread.select(
        F.when(one, F.pmod(F.xxhash64("least"), F.lit(bundles))).otherwise(F.col("least")).alias("bundle"),
        F.when(one, -1).otherwise(F.least("block", "other")).alias("side_a"),
        F.when(one, -1).otherwise(F.greatest("block", "other")).alias("side_b"),
        F.when(one | (F.col("block") == F.col("other")), 0).when(F.col("block") < F.col("other"), 1).otherwise(2).alias("side"),
        "least", "node", "copies", "shingles",
    )


def _classed(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The rows (id, key, node, ...), and (node, id, copies, n_nodes, n_documents, least) of
    their shingle sets, ``least`` naming the class."""
    named = pin(_nodes(docs, id_col, text_col))
    worded = named.where("node is not null")
    nodes = worded.groupBy("node").agg(
        F.min("id").alias("id"), F.min("key").alias("key"), F.count("*").alias("copies"), F.first("n").alias("n"),
        F.first("bands").alias("bands"),
    )
    nodes = pin(nodes)
    near = pin(_candidate_groups(nodes))
    leasts = near.unionByName(near.select(F.col("least").alias("name"), "least").distinct())
    chosen = pin(nodes.drop("bands").withColumn("name", F.xxhash64("node")).join(leasts, "name").drop("name"))
    groups = chosen.groupBy("least").agg(F.sum("n").alias("total"))
    groups = pin(groups.withColumn("blocks", F.ceil(F.col("total") / BLOCK_SHINGLES)))
    links = pin(_verified(_bundled(_members(docs, chosen, id_col, text_col), groups)))

    ties = least_of_component(links.select(F.col("node").alias("u"), F.col("tied").alias("v")))
    counts = links.groupBy("node").agg(F.sum("n_nodes").alias("n_nodes"), F.sum("n_documents").alias("n_documents"))
    classed = nodes.select("node", "id", "copies").join(counts, "node", "left").join(ties, "node", "left")
    return named, pin(classed.withColumn("least", F.coalesce("least", "node")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, class_id, n_links, n_texts, n_copies) for every row.

    ``n_links`` counts the other documents of similarity LEAST or more, copies
    included; ``n_texts`` the different shingle sets among them; ``n_copies`` the
    rows with the same set, itself included.  ``class_id`` is the least id of all
    that are linked directly or through others.  Rows that share an id count one by
    one.  Null and empty texts and texts without a word have no links and no copies,
    and are a class each (``n_copies`` is 1); a null id never is the least if another is there.
    """
    named, classed = _classed(docs, id_col, text_col)
    firsts = classed.groupBy("least").agg(F.min("id").alias("class_id"))
    classed = classed.join(firsts, "least").select(
        "node", "class_id", "copies",
        (F.coalesce("n_documents", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("n_nodes", F.lit(0)).alias("n_texts"),
    )
    joined = named.select("id", "node").join(classed, "node", "left")
    alone = F.col("node").isNull()
    return joined.select(
        F.col("id").alias(id_col), F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("n_texts", F.lit(0)).cast("long").alias("n_texts"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies"),
    )


def keep_one_of_each_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each class of ``docs``: that of the least id, of equal ids the one whose
    text's hash is least, a row without an id only where none has one.  Rows that share
    an id but no class all stay, as do texts without words; of rows alike in id and
    text one stays."""
    named, classed = _classed(docs, id_col, text_col)
    rows = named.select("id", "key", "node").join(classed.select("node", "least"), "node")
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "key")).alias("first")
    firsts = pin(rows.groupBy("least").agg(first))
    is_first = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("key") == F.col("first.key"))
    judged = rows.join(firsts, "least").select("id", "key", is_first.alias("stays"))
    judged = pin(judged.groupBy("id", "key").agg(F.max("stays").alias("stays"), F.count("*").alias("n")))
    keyed = docs.withColumn("_ql_key", _text_key(text_col))

    def same(side: DataFrame) -> Column:
        return keyed[id_col].eqNullSafe(side["id"]) & (keyed["_ql_key"] == side["key"])

    gone = judged.where("not stays")
    kept = keyed.join(gone, same(gone), "left_anti")
    again = judged.where("stays and n > 1")
    if again.isEmpty():
        return kept.drop("_ql_key")
    repeated = kept.join(again, kept[id_col].eqNullSafe(again["id"]) & (kept["_ql_key"] == again["key"]), "left_semi")
    single = kept.join(again, kept[id_col].eqNullSafe(again["id"]) & (kept["_ql_key"] == again["key"]), "left_anti")
    return single.unionByName(repeated.dropDuplicates([id_col, "_ql_key"])).drop("_ql_key")
