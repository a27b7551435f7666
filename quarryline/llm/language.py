"""Language identification by n-gram filters that answer with sets of languages.

The filter is a bit-sliced Bloom filter: a row of language bits in every slot.
An n-gram sets its language's bit in HASHES slots; the rows of its slots and-ed
together are the languages that (probably) contain it.  A text's n-grams are
counted per language; the count is corrected by the share of n-grams that each
language's bits would admit by chance, and the greatest corrected share decides.

N-grams are runs of GRAM_BYTES bytes of lower-case text in which everything in
ASCII but letters is a blank, so the whole text is hashed as arrays.  A text
begins and ends with a blank, as its words do; one in which no run holds
LEAST_LETTERS letters has no n-gram and cannot be identified.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarryline.llm.wordhash import mixed, text_blocks
from quarryline.session import pin

GRAM_BYTES = 5
LEAST_LETTERS = 3
SLOTS_BITS = 20
HASHES = 3
# Training reads about this many labelled documents, chosen by a hash of the id.
TRAIN_DOCUMENTS = 40_000
# An n-gram enters a language's filter when it is at least this share of the language's n-grams.
LEAST_SHARE = 2e-6
MOST_LANGUAGES = 512
UNKNOWN = "und"
# Held-out texts of sf0.01 score 0.80 and more, 0.40 above the second language; with their language
# left out they score 0.41 at most.
LEAST_SCORE = 0.5
LEAST_MARGIN = 0.1


class Filters(NamedTuple):
    languages: list[str]
    rows: np.ndarray  # slots x words of 64 language bits
    chance: np.ndarray  # per language, the share of foreign n-grams its bits admit


def _letters() -> np.ndarray:
    table = np.full(256, 0x20, np.uint8)
    table[0x61:0x7B] = np.arange(0x61, 0x7B)
    table[0x41:0x5B] = np.arange(0x61, 0x7B)
    table[0x80:] = np.arange(0x80, 0x100)
    return table


_LETTERS = _letters()
_HAS_LETTER = r"\p{L}"


def _padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The block with a blank before and after each text."""
    texts = np.arange(len(offsets))
    out = np.full(len(data) + 2 * len(texts[1:]), 0x20, np.uint8)
    out[np.arange(len(data)) + np.repeat(2 * texts[:-1] + 1, np.diff(offsets))] = data
    return out, offsets + 2 * texts


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram hashes, text of each) of a block of lower-case texts."""
    data, offsets = _padded(data, offsets)
    n = len(data) - GRAM_BYTES + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    folded = _LETTERS[data]
    gram = np.zeros(n, np.uint64)
    letters = np.zeros(n, np.int8)
    for k in range(GRAM_BYTES):
        part = folded[k : k + n]
        gram = (gram << np.uint64(8)) | part
        letters += part != 0x20
    good = letters >= LEAST_LETTERS
    for k in range(1, GRAM_BYTES):  # none reaches into the next text
        over = offsets[1:-1] - k
        good[over[(over >= 0) & (over < n)]] = False
    where = np.flatnonzero(good)
    return mixed(gram[where]), np.searchsorted(offsets, where, "right") - 1


def _lowered(column: pa.Array) -> pa.Array:
    return pc.utf8_lower(column.cast(pa.large_string()).fill_null(""))


def _slots(grams: np.ndarray) -> Iterator[np.ndarray]:
    mask = np.uint64((1 << SLOTS_BITS) - 1)
    for k in range(HASHES):
        yield ((grams >> np.uint64(k * SLOTS_BITS)) & mask).astype(np.int64)


def train(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text") -> Filters:
    """Filters from labelled texts; labels and texts that are null teach nothing.

    Every task counts its n-grams per language; the counts are added up in Spark, frequent n-grams become slots and bits, and
    at most 2**SLOTS_BITS slots with their bits come to the driver: 8 MB for each
    64 languages.  More than MOST_LANGUAGES labels are an error.
    """
    labelled = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(lang_col, text_col)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Distinct (language, n-gram, count), of a bounded stretch of the task's texts at a time."""
        for batch in batches:
            names = batch.column(0).to_pylist()
            for row, data, offsets in text_blocks(_lowered(batch.column(1))):
                grams, text = _grams(data, offsets)
                languages = np.array(names[row : row + len(offsets) - 1], object)
                for name in set(languages):
                    found, counts = np.unique(grams[(languages == name)[text]], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(found), pa.string()), pa.array(found.view(np.int64)), pa.array(counts)], ["l", "gram", "n"]
                    )

    counted = labelled.mapInArrow(count, "l string, gram long, n long").groupBy("l", "gram").agg(F.sum("n").alias("n"))
    counted = pin(counted)
    totals = counted.groupBy("l").agg(F.sum("n").alias("total")).orderBy("l").limit(MOST_LANGUAGES + 1).collect()
    if len(totals) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} labels; a label column is wanted")
    languages = [r["l"] for r in totals]
    n_words = max(1, -(-len(languages) // 64))
    rows = np.zeros((1 << SLOTS_BITS, n_words), np.uint64)
    if not languages:
        return Filters([], rows, np.zeros(0))
    place = F.create_map(*[x for i, r in enumerate(totals) for x in (F.lit(r["l"]), F.lit(i))])
    least = F.create_map(*[x for r in totals for x in (F.lit(r["l"]), F.lit(LEAST_SHARE * r["total"]))])
    chosen = counted.where(F.col("n") >= least[F.col("l")]).select("gram", place[F.col("l")].alias("language"))
    slots = F.array(*[
        F.shiftrightunsigned("gram", k * SLOTS_BITS).bitwiseAND((1 << SLOTS_BITS) - 1) for k in range(HASHES)
    ])
    bits = chosen.select(F.explode(slots).alias("slot"), F.floor(F.col("language") / 64).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), F.col("language") % 64).alias("bit"))
    bits = bits.groupBy("slot", "word").agg(F.bit_or("bit").alias("bits"))
    for r in bits.select("slot", "word", "bits").toArrow().to_batches():
        rows[r.column(0).to_numpy(), r.column(1).to_numpy()] = r.column(2).to_numpy().view(np.uint64)
    fill = np.array([(rows[:, i // 64] >> np.uint64(i % 64) & np.uint64(1)).mean() for i in range(len(languages))])
    return Filters(languages, rows, fill**HASHES)


def _scores(filters: Filters, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Corrected shares, texts x languages."""
    n_texts = len(offsets) - 1
    grams, text = _grams(data, offsets)
    totals = np.bincount(text, minlength=n_texts)
    rows = None
    for slots in _slots(grams):
        rows = filters.rows[slots] if rows is None else rows & filters.rows[slots]
    shares = np.zeros((n_texts, len(filters.languages)))
    for i, chance in enumerate(filters.chance):
        hits = np.bincount(text, (rows[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1), n_texts)
        share = hits / np.maximum(totals, 1)
        shares[:, i] = np.clip((share - chance) / max(1 - chance, 1e-9), 0, 1)
    return shares


def _judged(docs: DataFrame, filters: Filters, text_col: str, keep: list[str]) -> DataFrame:
    """``predict`` with ``_ql_margin``, the lead of the score over the second language."""
    languages = filters.languages

    def guess(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            names, best, second = np.full(len(texts), -1), np.zeros(len(texts)), np.zeros(len(texts))
            if languages:
                for row, data, offsets in text_blocks(_lowered(texts)):
                    shares = _scores(filters, data, offsets)
                    names[row : row + len(shares)] = shares.argmax(1)
                    best[row : row + len(shares)] = shares.max(1)
                    if len(languages) > 1:
                        second[row : row + len(shares)] = np.partition(shares, -2, axis=1)[:, -2]
            labels = pa.array([languages[i] if i >= 0 else UNKNOWN for i in names], pa.string())
            yield pa.StructArray.from_arrays(
                [labels, pa.array(best, pa.float64()), pa.array(best - second, pa.float64())], ["lang_pred", "score", "margin"]
            )

    guessed = F.arrow_udf(guess, "lang_pred string, score double, margin double")(F.col(text_col))
    has_letter = F.coalesce(F.rlike(F.col(text_col), F.lit(_HAS_LETTER)), F.lit(False))
    rows = docs.select(*[F.col(c) for c in dict.fromkeys(keep)], has_letter.alias("_ql_letter"), guessed.alias("_ql_guess"))
    return rows.select(
        *keep,
        F.when(F.col("_ql_letter"), F.col("_ql_guess.lang_pred")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(F.col("_ql_letter"), F.col("_ql_guess.score")).otherwise(0.0).alias("score"),
        F.when(F.col("_ql_letter"), F.col("_ql_guess.margin")).otherwise(0.0).alias("_ql_margin"),
    )


def predict(docs: DataFrame, filters: Filters, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) plus ``lang_pred`` and ``score``, a row for each row.

    The language of the greatest corrected share, among equals the one whose name
    sorts first; a text with letters but no known n-gram gets that too, with score
    0.  Null texts and texts without a letter are UNKNOWN with score 0, and so is
    everything if nothing was learned.
    """
    keep = docs.columns if keep is None else keep
    return _judged(docs, filters, text_col, keep).drop("_ql_margin")


def held_out(id_: Column) -> Column:
    """One document in five is never learned from."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train_on(docs: DataFrame, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text", most: int = TRAIN_DOCUMENTS) -> Filters:
    """``train`` on documents that are not held out, a bounded sample of about ``most`` of them."""
    candidates = docs.where(F.col(id_col).isNotNull() & ~held_out(F.col(id_col)) & F.col(lang_col).isNotNull())
    n = candidates.select(id_col).count()
    share = min(1.0, most / max(n, 1))
    return train(candidates.where(F.pmod(F.xxhash64(id_col), F.lit(1_000_000)) < share * 1_000_000), lang_col, text_col)


def keep_identified(
    docs: DataFrame, filters: Filters, least_score: float = LEAST_SCORE, text_col: str = "text", least_margin: float = LEAST_MARGIN,
) -> DataFrame:
    """The rows whose language is identified with at least ``least_score``, ``least_margin``
    above the second language; columns unchanged."""
    columns = docs.columns
    marked = docs.select(F.struct(*[F.col(c) for c in columns]).alias("_ql_row"), F.col(text_col).alias("_ql_text"))
    judged = _judged(marked, filters, "_ql_text", ["_ql_row"])
    sure = (F.col("score") >= least_score) & (F.col("_ql_margin") >= least_margin)
    return judged.where((F.col("lang_pred") != UNKNOWN) & sure).select("_ql_row.*")
