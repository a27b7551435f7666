"""Hashes of the words of many UTF-8 texts at once.

A word is a longest run of ASCII letters, ASCII digits and characters beyond
ASCII; A-Z count as a-z.  Arrow hands over one byte buffer and the offsets of
the texts, so a block of texts is hashed without a Python object per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

# Texts are hashed in blocks of about this many bytes, which bounds the arrays of a task.
BLOCK_BYTES = 2_000_000
SHINGLE_WORDS = 5


def _folded() -> np.ndarray:
    table = np.zeros(256, np.uint8)
    for low, high in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
        table[low : high + 1] = np.arange(low, high + 1)
    table[0x41 : 0x5B] = np.arange(0x61, 0x7B)
    return table


FOLDED = _folded()
BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
BASE_INVERSE = pow(BASE, -1, 1 << 64)
ORDER_FACTORS = np.array(
    [pow(0xC2B2AE3D27D4EB4F, k, 1 << 64) for k in range(1, SHINGLE_WORDS + 1)], np.uint64
)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of a 64-bit value spread over all bits (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers_up_to(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((BASE, BASE_INVERSE)):
            steps = np.full(max(n, BLOCK_BYTES), base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers


class Words(NamedTuple):
    """All words of a block of texts, in order of text and place."""

    hashes: np.ndarray
    text: np.ndarray  # which text of the block
    first: np.ndarray  # for each text, the place of its first word; one more at the end


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data, offsets


def text_blocks(column: pa.Array, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of whole texts of about ``block_bytes``."""
    if not len(column):
        return
    data, offsets = string_buffers(column)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + block_bytes, "right")) - 1
        end = min(max(end, row + 1), len(column))
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    n_texts, size = len(offsets) - 1, len(data)
    if not size:
        return Words(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(n_texts + 1, np.int64))
    folded = FOLDED[data]
    inside = folded != 0
    begins = np.empty(size + 1, bool)
    begins[1:size] = inside[1:] & ~inside[:-1]
    begins[0], begins[size] = inside[0], True
    edges = offsets[1:-1][offsets[1:-1] < size]
    begins[edges] = inside[edges]
    ends = np.empty(size, bool)
    ends[:-1] = inside[:-1] & (~inside[1:] | begins[1:size])
    ends[-1] = inside[-1]
    starts, ends = np.flatnonzero(begins[:size]), np.flatnonzero(ends) + 1
    power, inverse = _powers_up_to(size + 1)
    sums = np.zeros(size + 1, np.uint64)
    np.cumsum(folded * power[:size], out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    first = np.searchsorted(starts, offsets)
    return Words(hashes, np.repeat(np.arange(n_texts), np.diff(first)), first)


def hashes_of(words: list[str]) -> np.ndarray:
    """The same hashes for single words."""
    column = pa.array(words, pa.string())
    parts = [words_of(data, offsets).hashes for _, data, offsets in text_blocks(column)]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def shingles_of(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first of each text): runs of five words; a shorter text that has
    words is one shingle of all its words, a text without words has none."""
    counts = np.diff(words.first)
    n = len(words.hashes)
    padded = np.zeros(n + SHINGLE_WORDS - 1, np.uint64)
    padded[:n] = words.hashes
    within = np.arange(n) - words.first[words.text]
    left = counts[words.text] - within  # words from here to the end of the text
    total = np.zeros(n, np.uint64)
    for k in range(SHINGLE_WORDS):
        part = padded[k : k + n] * ORDER_FACTORS[k]
        total += np.where(left > k, part, np.uint64(0)) if k else part
    wanted = (left >= SHINGLE_WORDS) | (within == 0)
    per_text = np.bincount(words.text[wanted], minlength=len(counts)) if n else np.zeros(len(counts), np.int64)
    return mixed(total[wanted]), np.concatenate([[0], np.cumsum(per_text)]).astype(np.int64)
