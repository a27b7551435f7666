"""Removal of byte strings that occur more than once, by suffix arrays of shards.

Every string of WINDOW bytes that starts at more than one place of all texts is
removed with all its occurrences; overlapping strings join to one removed run.
Texts are compared as UTF-8 bytes and no string crosses the end of a text.

Sharding.  The least hash among the GRAM-byte strings of a window (the leftmost of
equal ones) owns it.  Equal windows have equal owners at equal offsets, so they
meet in the shard of their owner's hash: consecutive windows of one owner travel as
one piece, and owners that occur once send nothing.  Equal pieces are combined in
every task to one content with a count.  The contents of a shard are joined to one
string whose suffixes are ordered by external induced sorting (``induced``); windows
are equal where neighbours in that order share WINDOW bytes.  A content alone with
its hash needs no order: its windows can equal none of another content.

Skew.  A shard is a run of whole hashes of at most SHARD_BYTES, or one hash, read from
a sorted partition; it holds different contents only.  A hash with over MOST_CONTENTS
of them (a passage that very many texts share, in different surroundings) or over
HASH_BYTES (long stretches that repeat themselves) is divided: windows whose owner lies
at nearly the same offset share a longer core, whose hash takes the owner's place.
Cores grow from level to level to whole windows, which need no order; windows inside
the passage become equal contents, those beyond it cores that occur once.  Copies of a
whole text are one text with a count.

Defined cases: a null text is empty; a text under WINDOW bytes keeps all; a text
with an exact copy loses all if it has WINDOW bytes; rows without or with equal ids
are rows of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.llm import induced
from quarryline.llm.wordhash import mixed, text_blocks
from quarryline.session import scratch_path

WINDOW = 400
GRAM = 100
# A shard is ordered in memory, at about 50 bytes for each of its own.
SHARD_BYTES = 2_000_000
MOST_CONTENTS = 5_000
HASH_BYTES = 4_000_000
# Bytes of texts hashed at once, at about 100 bytes for each.
HASHED_BYTES = 500_000
# Offsets of an owner that share a core, by level; WINDOW - GRAM + 1 offsets share the owner.
CORE_WIDTHS = (75, 19, 5, 1)
# Bytes of pieces that one partition of shards should hold.
PARTITION_BYTES = 32_000_000

OWNERS = "_ql_key binary, hash long, start long, windows long, owners long"
PIECES = "_ql_key binary, hash long, start long, owners long, piece binary, copies long, digest binary"
WINDOWS = "_ql_key binary, hash long, check long, start long, windows long, met long"
RUNS = "digest binary, low long, high long"
DIGEST = "_ql_key binary, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"
# Odd multipliers of the two byte hashes; the second belongs to whole windows only.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers_of(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    if base not in _powers or len(_powers[base][0]) < n:
        both = []
        for factor in (base, pow(base, -1, 1 << 64)):
            steps = np.full(n, factor, np.uint64)
            steps[0] = 1
            both.append(np.cumprod(steps))
        _powers[base] = tuple(both)
    return _powers[base]


def string_hashes(data: np.ndarray, width: int, base: int = BASES[0]) -> np.ndarray:
    """A hash of every string of ``width`` bytes."""
    n = len(data)
    if n < width:
        return np.zeros(0, np.uint64)
    power, inverse = _powers_of(base, n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n], out=sums[1:])
    return mixed((sums[width:] - sums[:-width]) * inverse[: n - width + 1])


def _least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def owners_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, hash, start, windows, owners) of a block of texts: runs of windows
    whose owners have one hash."""
    if len(data) < WINDOW:
        return (np.zeros(0, np.int64),) * 5
    grams = string_hashes(data, GRAM)
    ranked = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    owner = (_least_in_windows(ranked, WINDOW - GRAM + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    counts = np.maximum(np.diff(offsets) - WINDOW + 1, 0)  # windows of each text
    text = np.repeat(np.arange(len(counts)), counts)
    window = np.arange(len(text)) + np.repeat(offsets[:-1] - np.cumsum(counts) + counts, counts)
    owner = owner[window]
    if not len(owner):
        return (np.zeros(0, np.int64),) * 5
    moves = np.append(True, (owner[1:] != owner[:-1]) | (text[1:] != text[:-1]))
    hashes = grams[owner]
    opens = np.flatnonzero(np.append(True, (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])))
    windows = np.diff(np.append(opens, len(owner)))
    owners = np.add.reduceat(moves.astype(np.int64), opens)
    return text[opens], hashes[opens].view(np.int64), window[opens] - offsets[text[opens]], windows, owners


def _owner_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in OWNERS.split(", ")]
    for batch in batches:
        for row, data, offsets in text_blocks(batch.column("_ql_text"), HASHED_BYTES):
            # A longer text stands alone and goes in parts, each window in one of them.
            for low in range(0, max(len(data) - WINDOW + 1, 1), HASHED_BYTES) if len(offsets) == 2 else [0]:
                part = data[low : low + HASHED_BYTES + WINDOW - 1] if len(offsets) == 2 else data
                text, hashes, start, windows, owners = owners_of(part, np.minimum(offsets, len(part)))
                keys = batch.column("_ql_key").take(pa.array(text + row))
                columns = (c.astype(np.int64) for c in (hashes, start + low, windows, owners))
                yield pa.RecordBatch.from_arrays([keys, *map(pa.array, columns)], names)


def _piece_batch(keys, hashes, starts, owners, pieces: list[bytes], copies) -> pa.RecordBatch:
    digests = [hashlib.blake2b(piece, digest_size=16).digest() for piece in pieces]
    columns = [keys, hashes, starts, owners, pa.array(pieces, pa.binary()), copies, pa.array(digests, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in PIECES.split(", ")])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut the stretches that ``_ql_places`` names out of each text."""
    for batch in batches:
        texts, places = batch.column("_ql_text").cast(pa.large_binary()), batch.column("_ql_places")
        lengths = pc.list_value_length(places).to_numpy(zero_copy_only=False)
        fields = dict(zip(("hash", "start", "windows", "owners"), places.flatten().flatten(), strict=True))
        row = np.repeat(np.arange(len(batch)), lengths)
        starts, windows = fields["start"].to_numpy(), fields["windows"].to_numpy()
        # Few pieces at a time, so that long texts do not double the batch.
        for low in range(0, len(row), 2_000):
            part = slice(low, low + 2_000)
            held, cut = None, []
            for r, s, w in zip(row[part].tolist(), starts[part].tolist(), windows[part].tolist(), strict=True):
                if held != r:
                    held, raw = r, memoryview(texts[r].as_buffer())
                cut.append(bytes(raw[s : s + w + WINDOW - 1]))
            keys = batch.column("_ql_key").take(pa.array(row[part]))
            one = pa.array(np.ones(len(cut), np.int64))
            yield _piece_batch(keys, fields["hash"][part], fields["start"][part], fields["owners"][part], cut, one)


def _cores(piece: bytes, width: int) -> tuple[np.ndarray, ...]:
    """(first window, windows, owners, place of the core) of the runs of windows of a
    piece whose owner lies at one of ``width`` offsets, where runs of one core are one."""
    data = np.frombuffer(piece, np.uint8)
    grams = string_hashes(data, GRAM)
    ranked = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    owner = (_least_in_windows(ranked, WINDOW - GRAM + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    core = owner - (owner - np.arange(len(owner))) // width * width
    hashes = string_hashes(data, WINDOW - width + 1)[core]
    moves = np.append(True, (core[1:] != core[:-1]) | (owner[1:] != owner[:-1]))
    opens = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
    owners = np.add.reduceat(moves.astype(np.int64), opens)
    return opens, np.diff(np.append(opens, len(owner))), owners, hashes[opens].view(np.int64)


def _divided(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """The pieces of contents by longer cores, each keyed by the content it lies in."""
    for batch in batches:
        for row, piece in enumerate(batch.column("piece").to_pylist()):
            first, windows, owners, hashes = _cores(piece, width)
            cut = [piece[f : f + w + WINDOW - 1] for f, w in zip(first.tolist(), windows.tolist(), strict=True)]
            keys, copies = (pa.repeat(batch.column(c)[row], len(cut)) for c in ("digest", "copies"))
            yield _piece_batch(keys, pa.array(hashes), pa.array(first), pa.array(owners), cut, copies)


def _single_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different windows of contents with a 128-bit hash of all their bytes and how often
    they are met there; then the runs of windows that a content repeats, met no more."""
    names = [f.split()[0] for f in WINDOWS.split(", ")]
    for batch in batches:
        for row, piece in enumerate(batch.column("piece")):
            data = np.frombuffer(piece.as_buffer(), np.uint8)
            hashes, checks = (string_hashes(data, WINDOW, base).view(np.int64) for base in BASES)
            order = np.lexsort((checks, hashes))
            opens = np.append(True, (hashes[order[1:]] != hashes[order[:-1]]) | (checks[order[1:]] != checks[order[:-1]]))
            opens = np.flatnonzero(opens)
            times = np.diff(np.append(opens, len(order)))
            again = np.zeros(len(order) + 1, np.int8)
            again[order] = np.repeat(times > 1, times)
            edges = np.diff(again, prepend=0)
            first, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
            start = np.concatenate([order[opens], first])
            windows = np.concatenate([np.ones(len(opens), np.int64), end - first])
            met = np.concatenate([times * batch.column("copies")[row].as_py(), np.zeros(len(first), np.int64)])
            keys = pa.repeat(batch.column("digest")[row], len(start))
            yield pa.RecordBatch.from_arrays([keys, *map(pa.array, (hashes[start], checks[start], start, windows, met))], names)


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    return np.frombuffer(data, np.uint8), np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]


def _repeated_in(contents: pa.Array, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """(content, first window, end) of the runs of windows of these different contents
    that stand at several places, a content counting as often as ``counts`` says."""
    data, offsets = _bytes_of(contents)
    lengths = np.diff(offsets)
    n = len(lengths)
    size = int(lengths.sum()) + n
    begin = offsets[:-1] - offsets[0] + np.arange(n)  # each content ends with a 1
    inside = np.ones(size, bool)
    inside[begin + lengths] = False
    text = np.full(size + 1, -1, np.int32)
    text[:-1][inside] = data[offsets[0] : offsets[-1]]
    text += 2
    text[-1] = 0
    # At each place, how often its window counts: not at all, once, or more.
    weight, often = np.zeros(size + 1, np.int8), np.minimum(counts, 2).astype(np.int8)
    weight[begin] += often
    weight[begin + np.maximum(lengths - WINDOW + 1, 0)] -= often
    weight = np.cumsum(weight, dtype=np.int8)
    repeated = np.append(weight == 2, False).astype(np.int8)
    with induced.Scratch() as scratch:
        order, shared = induced.suffix_order(text, WINDOW, scratch)
        del text, inside
        alike = shared >= WINDOW  # with the one before it
        member = np.flatnonzero(alike | np.append(alike[1:], False))
        opens = np.flatnonzero(~alike[member])
        place = order[member]
    if len(place):
        times = np.diff(np.append(opens, len(place)))
        total = np.add.reduceat(weight[place], opens, dtype=np.int64)
        repeated[place[np.repeat(total >= 2, times) & (weight[place] > 0)]] = 1
    edges = np.diff(repeated, prepend=0)
    first, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    owner = np.searchsorted(begin, first, "right") - 1
    return owner, first - begin[owner], end - begin[owner]


def repeats_in_shard(table: pa.Table) -> pa.RecordBatch:
    """The runs of bytes of the contents of a shard whose windows occur in it more
    than once; contents that occur more than once themselves are left out."""
    counts = table["copies"].to_numpy()
    owner, first, end = _repeated_in(table["piece"].combine_chunks(), counts)
    single = counts[owner] == 1
    digests = table["digest"].combine_chunks().take(pa.array(owner[single]))
    return pa.RecordBatch.from_arrays([digests, pa.array(first[single]), pa.array(end[single] + WINDOW - 1)], ["digest", "low", "high"])


def _whole_hashes(table: pa.Table) -> int:
    """Rows of the first shard of sorted contents, or 0 where more rows may belong to it."""
    hashes = table["hash"].to_numpy()
    ends = np.cumsum(pc.binary_length(table["piece"]).to_numpy())
    borders = np.flatnonzero(hashes[1:] != hashes[:-1]) + 1
    if ends[-1] <= SHARD_BYTES or not len(borders):
        return 0
    return int(borders[max(0, int(np.searchsorted(ends[borders - 1], SHARD_BYTES, "right")) - 1)])


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted contents in runs of whole hashes of at most SHARD_BYTES, or of one hash."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = pa.concat_tables([held, table]) if held is not None else table
        while len(held) and (rows := _whole_hashes(held)):
            yield repeats_in_shard(held.slice(0, rows))
            held = held.slice(rows)
    if held is not None and len(held):
        yield repeats_in_shard(held)


def distinct_texts(docs: DataFrame) -> DataFrame:
    """Each text once, with a 128-bit key and its count; copies are combined in every task."""
    return docs.groupBy("_ql_key").agg(F.first("_ql_text").alias("_ql_text"), F.count("*").alias("_ql_copies"))


def keyed(docs: DataFrame, text: str = "text") -> DataFrame:
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumns({"_ql_text": whole, "_ql_key": F.substring(F.unhex(F.sha2(whole, 256)), 1, 16)})


def _repeated_windows(contents: DataFrame) -> DataFrame:
    """Runs of contents from the counts of their single windows."""
    windows = contents.mapInArrow(_single_windows, WINDOWS)
    met = windows.groupBy("hash", "check").agg(F.sum("met").alias("_ql_met")).where("_ql_met > 1")
    high = (F.col("start") + F.col("windows") + (WINDOW - 1)).alias("high")
    return windows.join(met, ["hash", "check"]).select(F.col("_ql_key").alias("digest"), F.col("start").alias("low"), high)


def _spans_of_pieces(pieces: DataFrame, level: int = 0) -> DataFrame:
    """(_ql_key, start, end) of the repeated windows of pieces."""
    spark = pieces.sparkSession
    path = scratch_path(spark, f"pieces-{level}")
    pieces.write.parquet(path)
    pieces = spark.read.parquet(path)
    contents = pieces.groupBy("hash", "digest").agg(
        F.first("piece").alias("piece"), F.first("owners").alias("owners"), F.sum("copies").alias("copies")
    )
    # How many contents, and how many bytes of them, have one hash.
    sizes = pieces.select("hash", "digest", F.length("piece").alias("size"), "owners").distinct()
    sizes = sizes.groupBy("hash").agg(F.count("*").alias("_ql_n"), F.sum("size").alias("_ql_size"), F.max("owners").alias("_ql_owners"))
    compared = sizes.where("_ql_n > 1 OR _ql_owners > 1")
    hot = (F.col("_ql_n") > MOST_CONTENTS) | (F.col("_ql_size") > HASH_BYTES)
    facts = compared.agg(F.sum(F.when(~hot, F.col("_ql_size"))).alias("size"), F.count_if(hot).alias("hot")).first()
    contents = contents.join(compared.select("hash", hot.alias("_ql_hot")), "hash", "left")
    often = contents.where("copies > 1").select("digest", F.lit(0).cast("long").alias("low"), F.length("piece").cast("long").alias("high"))
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(facts["size"] or 0) // PARTITION_BYTES))
    sharded = contents.where("NOT _ql_hot").select("hash", "digest", "piece", "copies").repartition(partitions, "hash")
    runs = often.unionByName(sharded.sortWithinPartitions("hash").mapInArrow(_shards, RUNS))
    if facts["hot"]:
        divided, width = contents.where("_ql_hot").select("digest", "piece", "copies"), CORE_WIDTHS[level]
        if width == 1:
            inside = _repeated_windows(divided)
        else:
            inside = _spans_of_pieces(divided.mapInArrow(lambda b: _divided(b, width), PIECES), level + 1)
            inside = inside.toDF("digest", "low", "high")
        runs = runs.unionByName(inside)
    start = F.col("start")
    return pieces.select("_ql_key", "start", "digest").join(runs, "digest").select(
        "_ql_key", (start + F.col("low")).alias("start"), (start + F.col("high")).alias("end")
    )


def repeated_spans(texts: DataFrame) -> DataFrame:
    """(_ql_key, start, end) of byte runs of different texts made of repeated windows;
    runs may overlap.  Owners and pieces are written to the shared folder and read twice."""
    spark = texts.sparkSession
    path = scratch_path(spark, "owners")
    texts.mapInArrow(_owner_rows, OWNERS).write.parquet(path)
    owners = spark.read.parquet(path)
    met = owners.groupBy("hash").agg(F.sum("owners").alias("_ql_met")).where("_ql_met > 1")
    places = owners.join(met, "hash").select("_ql_key", F.struct("hash", "start", "windows", "owners").alias("_ql_place"))
    of_text = places.groupBy("_ql_key").agg(F.collect_list("_ql_place").alias("_ql_places"))
    return _spans_of_pieces(texts.join(of_text, "_ql_key").mapInArrow(_pieces, PIECES))


def _without_spans(batches: Iterator[pa.RecordBatch], keep: bool) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in DIGEST.split(", ")]
    for batch in batches:
        texts = batch.column("_ql_text").cast(pa.large_binary())
        copies, spans = batch.column("_ql_copies").to_pylist(), batch.column("_ql_spans")
        rows = []
        for row in range(len(batch)):
            raw = memoryview(texts[row].as_buffer())
            if copies[row] > 1 and len(raw) >= WINDOW:
                removed = [(0, len(raw))]
            elif spans[row].is_valid:
                starts, ends = (c.to_numpy() for c in spans[row].values.flatten())
                order = np.argsort(starts, kind="stable")
                starts, ends = starts[order], np.maximum.accumulate(ends[order])
                opens = np.flatnonzero(np.append(True, starts[1:] > ends[:-1]))
                removed = list(zip(starts[opens].tolist(), ends[np.append(opens[1:], len(ends)) - 1].tolist(), strict=True))
            else:
                removed = []
            kept, at, n_removed = [], 0, 0
            for start, end in removed:
                kept.append(raw[at:start])
                at, n_removed = end, n_removed + end - start
            kept = b"".join([*kept, raw[at:]])
            rows.append((len(raw), n_removed, len(removed), kept if keep else None, hashlib.sha256(kept).hexdigest()))
        columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string()), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("_ql_key"), *columns], names)


def drop_repeats(docs: DataFrame, text: str = "text", keep_bytes: bool = True) -> DataFrame:
    """``docs`` without the text column, and with ``_ql_n_bytes``, ``_ql_n_removed``,
    ``_ql_n_spans``, ``_ql_kept_sha256`` and, unless turned off, ``_ql_kept``: the
    bytes left, which may begin or end within a character."""
    docs = keyed(docs, text)
    texts = distinct_texts(docs)
    spans = repeated_spans(texts).groupBy("_ql_key").agg(F.collect_list(F.struct("start", "end")).alias("_ql_spans"))
    cut = texts.join(spans, "_ql_key", "left").mapInArrow(lambda b: _without_spans(b, keep_bytes), DIGEST)
    wanted = ["n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * keep_bytes
    cut = cut.select("_ql_key", *[F.col(c).alias(f"_ql_{c}") for c in wanted])
    return docs.drop("_ql_text", text).join(cut, "_ql_key").drop("_ql_key")
