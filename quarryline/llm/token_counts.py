"""Greedy word-piece counts by one automaton pass (linear longest match).

The vocabulary becomes a trie.  Every node has a failure link and the number of
tokens popped on the way there: when no child fits the next character, the
longest tokens that cover what was read are popped, and the walk goes on at the
node of the rest.  A word is thus counted in time linear in its length, and no
piece is ever built.  Words of a batch walk side by side, one character a step.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

WORD_START = "▁"
# Counts of words seen are kept per task up to this many words, then forgotten.
REMEMBERED_WORDS = 400_000
# Words of several texts walk through the automaton together.
WORDS_AT_ONCE = 300_000
SCHEMA = "n_words long, n_tokens long, n_unknown long"


def piece_vocabulary(model_file: str) -> list[str]:
    """The pieces of a sentence-piece model that stand for text; those of a word's start carry the mark."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    special = (model.is_control, model.is_unknown, model.is_byte, model.is_unused)
    return [model.id_to_piece(i) for i in range(model.get_piece_size()) if not any(test(i) for test in special)]


# So few words are walked one by one; more of them side by side.
FEW_WORDS = 4


class Automaton(NamedTuple):
    alphabet: np.ndarray  # sorted code points of the vocabulary
    edges: np.ndarray  # sorted node * len(alphabet) + character
    targets: np.ndarray
    fail: np.ndarray  # -1: nothing fits
    pops: np.ndarray  # tokens popped by following the link
    closing: np.ndarray  # tokens popped when the word ends here; -1: the word is unknown

    @classmethod
    def build(cls, vocabulary: Iterable[str]) -> Automaton:
        children: list[dict[str, int]] = [{}]
        token = [False]
        for piece in vocabulary:
            node = 0
            for character in piece:
                if character not in children[node]:
                    children[node][character] = len(children)
                    children.append({})
                    token.append(False)
                node = children[node][character]
            token[node] = node > 0
        fail, pops = np.full(len(children), -1, np.int32), np.zeros(len(children), np.int32)
        queue = deque([0])
        while queue:
            node = queue.popleft()
            for character, child in children[node].items():
                queue.append(child)
                if token[child]:
                    fail[child], pops[child] = 0, 1
                    continue
                at, popped = fail[node], pops[node]
                while at >= 0 and character not in children[at]:
                    popped += pops[at]
                    at = fail[at]
                if at >= 0:
                    fail[child], pops[child] = children[at][character], popped
        closing = np.full(len(children), -1, np.int32)
        closing[0] = 0
        for node in sorted(range(1, len(children)), key=lambda n: _depth_key(n, fail)):
            total, at = 0, node
            while at > 0 and closing[at] < 0:
                if fail[at] < 0:
                    break
                total += pops[at]
                at = fail[at]
            if closing[at] >= 0:
                closing[node] = total + closing[at]
        alphabet = np.array(sorted({ord(c) for kids in children for c in kids}), np.int64)
        place = {chr(c): i for i, c in enumerate(alphabet)}
        edges, targets = [], []
        for node, kids in enumerate(children):
            for character, child in kids.items():
                edges.append(node * len(alphabet) + place[character])
                targets.append(child)
        order = np.argsort(np.array(edges, np.int64))
        return cls(alphabet, np.array(edges, np.int64)[order], np.array(targets, np.int32)[order], fail, pops, closing)

    def _step(self, nodes: np.ndarray, characters: np.ndarray) -> np.ndarray:
        """The children reached, -1 where there is none."""
        if not len(self.edges):
            return np.full(len(nodes), -1, np.int32)
        keys = nodes * len(self.alphabet) + characters
        places = np.minimum(np.searchsorted(self.edges, keys), len(self.edges) - 1)
        return np.where((self.edges[places] == keys) & (characters >= 0), self.targets[places], -1)

    def _children(self) -> dict[int, int]:
        return dict(zip(self.edges.tolist(), self.targets.tolist(), strict=True))

    def _walk(self, children: dict[int, int], characters: np.ndarray, node: int, count: int) -> tuple[int, int, bool]:
        """The node reached from ``node``, the tokens popped, and whether all fitted; one character at a time."""
        size, fail, pops = len(self.alphabet), self.fail.tolist(), self.pops.tolist()
        for character in characters.tolist():
            reached = children.get(node * size + character) if character >= 0 else None
            while reached is None:
                if fail[node] < 0:
                    return node, count, False
                count += pops[node]
                node = fail[node]
                reached = children.get(node * size + character) if character >= 0 else None
            node = reached
        return node, count, True

    def counts(self, words: list[str]) -> np.ndarray:
        """Tokens of each word; -1 where some part of it is not in the vocabulary."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(-lengths, kind="stable")
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        places = np.minimum(np.searchsorted(self.alphabet, codes), max(len(self.alphabet) - 1, 0))
        characters = np.where(self.alphabet[places] == codes, places, -1) if len(self.alphabet) else np.full(len(codes), -1)
        begins = (np.cumsum(lengths) - lengths)[order]
        lengths = lengths[order]
        nodes, counts = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        alive = np.ones(len(words), bool)
        for step in range(int(lengths[0]) if len(words) else 0):
            longer = int(np.searchsorted(-lengths, -step, "left"))  # words with a character here
            if longer <= FEW_WORDS:
                children = self._children()
                for k in np.flatnonzero(alive[:longer]):
                    rest = characters[begins[k] + step : begins[k] + lengths[k]]
                    nodes[k], counts[k], alive[k] = self._walk(children, rest, int(nodes[k]), int(counts[k]))
                break
            todo = np.flatnonzero(alive[:longer])
            while len(todo):
                reached = self._step(nodes[todo], characters[begins[todo] + step])
                nodes[todo[reached >= 0]] = reached[reached >= 0]
                todo = todo[reached < 0]
                stuck = self.fail[nodes[todo]] < 0
                alive[todo[stuck]] = False
                todo = todo[~stuck]
                counts[todo] += self.pops[nodes[todo]]
                nodes[todo] = self.fail[nodes[todo]]
        ending = self.closing[nodes]
        result = np.empty(len(words), np.int64)
        result[order] = np.where(alive & (ending >= 0), counts + ending, -1)
        return result


def _depth_key(node: int, fail: np.ndarray) -> int:
    """Links lead to shorter strings; nodes near the end of a chain come first."""
    steps = 0
    while node > 0 and fail[node] >= 0:
        node, steps = fail[node], steps + 1
    return steps


def _blocks(text: str, size: int = 1 << 20) -> Iterator[list[str]]:
    """Words between blanks, a bounded stretch of the text at a time."""
    at = 0
    while at < len(text):
        end = at + size
        while end < len(text) and not text[end].isspace():
            end += 1
        yield text[at:end].split()
        at = end


def _gathered(texts: pa.Array, size: int = WORDS_AT_ONCE) -> Iterator[tuple[np.ndarray, list[str]]]:
    """(row of each word, words) of many texts, about ``size`` words at a time."""
    rows, counts, words = [], [], []
    for row, text in enumerate(texts):
        for block in _blocks(text.as_py() or ""):
            rows.append(row)
            counts.append(len(block))
            words += block
            if len(words) >= size:
                yield np.repeat(rows, counts), words
                rows, counts, words = [], [], []
    if words:
        yield np.repeat(rows, counts), words


def token_counts(docs: DataFrame, vocabulary: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_tokens, n_unknown) for every row, in one pass without a shuffle.

    Words stand between blanks; each is matched with WORD_START before it, the
    longest piece first.  A word with a part outside the vocabulary counts as one
    unknown token.  Null and empty texts have 0 of all; repeated rows and null
    ids give a row each; other columns are not read.
    """
    automaton = Automaton.build(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for batch in batches:
            sums = np.zeros((3, batch.num_rows), np.int64)
            for rows, words in _gathered(batch.column(1)):
                new = list(set(words) - known.keys())
                if len(known) + len(new) > REMEMBERED_WORDS:
                    known.clear()
                    new = list(set(words))
                known.update(zip(new, automaton.counts([WORD_START + w for w in new]).tolist()))
                found = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
                sums[0] += np.bincount(rows, minlength=batch.num_rows)
                sums[1] += np.bincount(rows, np.abs(found), batch.num_rows).astype(np.int64)
                sums[2] += np.bincount(rows[found < 0], minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, sums)], [id_col, "n_words", "n_tokens", "n_unknown"]
            )

    return docs.select(id_col, text_col).mapInArrow(count, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, {SCHEMA}")
