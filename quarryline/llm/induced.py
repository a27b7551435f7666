"""Order and common prefixes of all suffixes of a shard, by external induced sorting.

A suffix is small (S) if it is less than the one that starts a symbol later, else
large (L); a starred suffix is an S suffix behind an L suffix.  The stretches from
one starred place to the next are named in order; the string of names is ordered
by recursion, which orders the starred suffixes.  All others are induced: suffixes
are taken from priority queues in order, and each hands the suffix one symbol to
its left to the queue of that symbol, L suffixes in a forward pass, S suffixes in
a backward one.  Suffixes reach a queue in the order in which they must leave it,
so a queue is a stretch of a flat file with a place to read and a place to write.

A tuple of a queue is (place of the suffix, symbols shared with the one before it
in the queue).  The shared prefix of two suffixes that follow each other in a queue
is one more than the least shared prefix of all that was taken between them.

Arrays above ``resident`` bytes are files mapped into memory, so a shard may be far
larger than the memory of its task.  They lie in the task's own spill folder, that
of Spark's spills, are read by no other task and are gone when the order is made.

Shared prefixes are counted to ``depth`` symbols; suffixes that agree so far stand
next to each other in any order.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np

RESIDENT_BYTES = 64_000_000
CHUNK = 65_536  # tuples taken from a queue at once
# A string of names is ordered by induction again while a name stands this often on average, else by doubling.
NAMES_REPEAT = 64


class Scratch:
    """Arrays in memory, or in files of the task's spill folder if they are large."""

    def __init__(self, resident: int = RESIDENT_BYTES):
        self.resident, self.files, self.folder = resident, 0, None

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        if self.folder is not None:
            self.folder.cleanup()

    def array(self, n: int, dtype) -> np.ndarray:
        if n * np.dtype(dtype).itemsize <= self.resident:
            return np.empty(n, dtype)
        if self.folder is None:
            spill = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None
            self.folder = tempfile.TemporaryDirectory(prefix="suffixes-", dir=spill)
        self.files += 1
        return np.memmap(os.path.join(self.folder.name, str(self.files)), dtype, "w+", shape=n)


class _Queues:
    """One queue per symbol in a flat array; what each pass has taken so far."""

    def __init__(self, text, small, wanted: bool, depth: int, scratch: Scratch):
        sizes = np.bincount(text[small == wanted], minlength=int(text.max()) + 1)
        self.text, self.small, self.wanted, self.depth = text, small, wanted, depth
        self.begin = np.concatenate([[0], np.cumsum(sizes)])
        self.tail = self.begin[:-1].copy()
        total = int(self.begin[-1])
        self.place, self.shared = scratch.array(total, np.int32), scratch.array(total, np.int16)
        self.last = np.full(len(sizes), -1, np.int64)  # when a queue got its last tuple
        self.seen = np.full(depth + 1, -1, np.int64)  # when a shared prefix of that length was last met
        self.latest = self.seen.copy()  # the same for that length or less
        self.now = 0

    def take(self, place: np.ndarray, shared: np.ndarray) -> None:
        """Suffixes in order, each with its shared prefix with the one taken before it."""
        before = place - 1
        symbol = self.text[before]
        index = np.flatnonzero((self.small[before] == self.wanted) & (place > 0))
        if len(index):
            symbol = symbol[index]
            order = np.argsort(symbol, kind="stable")
            symbol, index = symbol[order], index[order]
            opens = np.empty(len(index), bool)
            opens[0] = True
            opens[1:] = symbol[1:] != symbol[:-1]
            first = np.flatnonzero(opens)
            queue = symbol[first]
            least = np.empty(len(index), np.int16)
            earlier = np.searchsorted(self.latest, self.last[queue], "right")
            least[first] = np.minimum(earlier, np.minimum.accumulate(shared)[index[first]])
            if len(first) < len(index):
                later = np.flatnonzero(~opens)
                least[later] = _least_between(shared, index[later - 1] + 1, index[later])
            value = np.minimum(least + 1, self.depth).astype(np.int16)
            value[first[self.tail[queue] == self.begin[queue]]] = 0
            count = np.diff(np.append(first, len(index)))
            at = self.tail[symbol] + np.arange(len(index)) - np.repeat(first, count)
            self.place[at], self.shared[at] = before[index], value
            self.tail[queue] += count
            self.last[queue] = self.now + index[first + count - 1]
        self.seen[shared] = np.arange(self.now, self.now + len(place))
        np.maximum.accumulate(self.seen, out=self.latest)
        self.now += len(place)

    def drain(self, symbol: int):
        """The tuples of one queue in chunks, those that come in meanwhile included."""
        head = int(self.begin[symbol])
        while head < self.tail[symbol]:
            end = min(int(self.tail[symbol]), head + CHUNK)
            yield self.place[head:end], self.shared[head:end]
            head = end


def _least_between(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The least of values[low..high], for many ranges (a table of powers of two)."""
    width = high - low + 1
    level = np.frexp(width)[1] - 1
    out, table = np.empty(len(low), values.dtype), values
    for k in range(int(level.max()) + 1):
        here = level == k
        out[here] = np.minimum(table[low[here]], table[high[here] - (1 << k) + 1])
        table = np.minimum(table[: -(1 << k)], table[1 << k :]) if len(table) > 1 << k else table
    return out


def _is_small(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each suffix is small, and the last place of every run of one symbol."""
    ends = np.flatnonzero(text[1:] != text[:-1])
    small = np.append(text[ends] < text[ends + 1], True)
    ends = np.append(ends, len(text) - 1)
    return np.repeat(small, np.diff(ends, prepend=-1)), ends


def _names(text: np.ndarray, small: np.ndarray, star: np.ndarray) -> np.ndarray:
    """The place in order of each stretch from a starred place to the next (both
    ends included), equal stretches alike.  Several symbols are compared at once."""
    bits = int(2 * int(text.max()) + 2).bit_length()
    per = max(1, 62 // bits)
    length = np.append(np.diff(star), 0) + 1
    rank = np.zeros(len(star), np.int64)
    active, offset = np.arange(len(star)), 0
    while len(active):
        pack = np.zeros(len(active), np.int64)
        for k in range(offset, offset + per):
            inside = length[active] > k
            at = star[active[inside]] + k
            pack <<= bits
            pack[inside] |= 2 * text[at].astype(np.int64) + small[at] + 1
        order = np.lexsort((pack, rank[active]))
        active, pack = active[order], pack[order]
        group = rank[active]
        opens = np.append(True, group[1:] != group[:-1])
        differs = opens.copy()
        differs[1:] |= pack[1:] != pack[:-1]
        index = np.arange(len(active))
        rank[active] = group + np.maximum.accumulate(np.where(differs, index, 0)) - np.maximum.accumulate(np.where(opens, index, 0))
        tied = ~(differs & np.append(differs[1:], True))
        offset += per
        active = active[tied & (length[active] > offset)]
    return np.unique(rank, return_inverse=True)[1].astype(np.int32)


def _by_doubling(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Order and shared prefixes from ranks of stretches of doubled length."""
    n = len(text)
    ranks, span = [text.astype(np.int32)], 1
    while span < depth and ranks[-1].max() < n - 1:
        key = ranks[-1].astype(np.int64) * (n + 1)
        key[: n - span] += ranks[-1][span:] + 1
        ranks.append(np.unique(key, return_inverse=True)[1].astype(np.int32))
        span *= 2
    order = np.argsort(ranks[-1], kind="stable")
    shared = np.zeros(n, np.int64)
    a, b = order[:-1], order[1:]
    for rank in reversed(ranks):
        padded = np.append(rank, -1)
        equal = padded[np.minimum(a + shared[1:], n)] == padded[np.minimum(b + shared[1:], n)]
        shared[1:] += np.where(equal, span, 0)
        span //= 2
    return order, np.minimum(shared, depth)


def _shared_from(text: np.ndarray, a: np.ndarray, b: np.ndarray, known: np.ndarray, depth: int) -> np.ndarray:
    """Symbols shared by the suffixes at a and b, of which ``known`` are known to agree."""
    shared = np.minimum(known, depth)
    active = np.flatnonzero(shared < depth)
    while len(active):
        at = shared[active]
        active = active[text[a[active] + at] == text[b[active] + at]]
        shared[active] += 1
        active = active[shared[active] < depth]
    return shared


def suffix_order(text: np.ndarray, depth: int, scratch: Scratch) -> tuple[np.ndarray, np.ndarray]:
    """(places, shared): all suffixes in order, and the symbols each shares with the
    one before it, up to ``depth``.  The last symbol must be 0 and stand nowhere else."""
    n = len(text)
    if n == 1:
        return np.zeros(1, np.int32), np.zeros(1, np.int16)
    small, ends = _is_small(text)
    star = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    names = _names(text, small, star)
    n_names = int(names.max()) + 1
    if n_names == len(star):
        order, common = np.argsort(names), np.zeros(len(star), np.int64)
    elif len(star) >= NAMES_REPEAT * n_names:
        order, common = suffix_order(names, depth, scratch)
        order, common = np.asarray(order, np.int64), np.asarray(common, np.int64)
    else:
        order, common = _by_doubling(names, depth)
    at = star[order]
    shared = np.zeros(len(star), np.int16)
    known = star[order[1:] + common[1:]] - at[1:]
    shared[1:] = _shared_from(text, at[:-1], at[1:], known, depth)

    def run(place: int) -> int:
        return min(int(ends[np.searchsorted(ends, place)]) - int(place) + 1, depth)

    forward = _Queues(text, small, False, depth, scratch)
    of_star = text[at]
    border = np.searchsorted(of_star, np.arange(len(forward.tail) + 1))
    symbols = range(len(forward.tail))
    for symbol in symbols:
        larger = None
        for places, common in forward.drain(symbol):
            forward.take(places, common)
            larger = places[-1]
        low, high = border[symbol], border[symbol + 1]
        for k in range(low, high, CHUNK):
            common = shared[k : min(high, k + CHUNK)].copy()
            if k == low:
                common[0] = 0 if larger is None else min(run(larger), run(at[low]))
            forward.take(at[k : min(high, k + CHUNK)], common)

    backward = _Queues(text, small, True, depth, scratch)
    places_out, shared_out = scratch.array(n, np.int32), scratch.array(n, np.int16)
    done = n

    def put(places: np.ndarray, common: np.ndarray) -> None:
        nonlocal done
        backward.take(places, common)
        places_out[done - len(places) : done] = places[::-1]
        # kept with the greater of the two suffixes
        end = min(done + 1, n)
        shared_out[done - len(places) + 1 : end] = common[::-1][: end - done + len(places) - 1]
        done -= len(places)

    for symbol in reversed(symbols):
        smaller = None
        for places, common in backward.drain(symbol):
            put(places, common)
            smaller = places[-1]
        low, high = int(forward.begin[symbol]), int(forward.begin[symbol + 1])
        for end in range(high, low, -CHUNK):
            begin = max(low, end - CHUNK)
            common = np.empty(end - begin, np.int16)
            common[1:] = forward.shared[begin + 1 : end][::-1]
            if end < high:
                common[0] = forward.shared[end]
            else:
                common[0] = 0 if smaller is None else min(run(smaller), run(forward.place[end - 1]))
            put(forward.place[begin:end][::-1], common)
    places_out[0], shared_out[0] = n - 1, 0
    if n > 1:
        shared_out[1] = 0
    return places_out, shared_out
