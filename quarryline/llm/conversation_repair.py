"""Repair of conversation structure by a Viterbi search that emits as its survivors meet.

The roles of a conversation must read ``(s?(ua)+)?`` by their first letters.  Edits:
keep a row (0), give it the role user or assistant (1), delete it (2; required for a
blank or duplicate row), insert an empty user or assistant row (5); a truncated row
that stays costs 5 more.  The cheapest edits win, of equally cheap ones those whose
letters (K, R, D, I) are least as text.

Rows are read once, in order.  Each of the four states of the pattern has one
survivor, the best edits so far that end in it, held as a leaf of a backpointer tree
whose nodes count their references.  What no survivor refers to is dropped; once all
survivors come from one node, the edits up to it are final and are emitted, so a
task holds the unresolved edits of one conversation, not its rows.  Two equally
cheap survivors of a state are compared by their whole letters since their common
ancestor: equal costs rule out that one is the beginning of the other, so the first
differing letter decides whatever follows, and pointers to far ancestors find it.
A state that can no longer win by cost is dropped (the empty start beside an ended
turn, say), or it would hold the tree open for ever.  Where two ways stay open to
the end, as in a conversation of one role only, its rows are held to the end.

One conversation is read in order by one task, as its repaired text is one hash of
rows in order.  Whether a row is a duplicate is found before, by a shuffle on
conversation, role and text, so no task holds the texts seen.

Defined cases: null roles and texts are one space; rows of one turn stand in the
order of role and text (code points); rows with a null turn stand first and have no
part in the gaps; a null conversation is one of its own; a role without a letter
adds none; a conversation without rows has zeros, no edits and the hash of nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLANK = r"^[\x20\x09-\x0D]*$"
TRUNCATED = r"[^\x20\x09-\x0D.!?][\x20\x09-\x0D]*$"
LEGAL = {"su", "ua", "au"}

KEEP, REROLE, DELETE, INSERT, CUT_SHORT = 0, 1, 2, 5, 5
START, SYSTEM, USER, ENDED = range(4)
STEPS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ENDED, (ENDED, "u"): USER}
NAMES = {USER: "user", ENDED: "assistant"}
NEXT = (USER, USER, ENDED, USER)  # where a user or assistant row leads


class _Node:
    """An edit on the way to a survivor, its length in letters and what refers to it.

    ``jump`` leads to a far ancestor such that any ancestor is reached in steps that
    grow with the logarithm of the length."""

    __slots__ = ("parent", "letter", "role", "text", "length", "references", "jump")

    def __init__(self, parent, letter, role=None, text=None):
        self.parent, self.letter, self.role, self.text = parent, letter, role, text
        self.references = 0
        if parent is None:
            self.length, self.jump = 0, self
            return
        self.length = parent.length + 1
        far = parent.jump
        self.jump = far.jump if parent.length - far.length == far.length - far.jump.length else parent

    def ancestor(self, length: int) -> _Node:
        node = self
        while node.length > length:
            node = node.jump if node.jump.length >= length else node.parent
        return node


def _first_by_letters(one: tuple, other: tuple) -> tuple:
    """Of two edits (cost, parent, letter, ...) of one cost, the one whose letters are less.

    Children of one node differ by letter, so the letters behind the last common
    ancestor decide."""
    a, b, x, y = one[1], other[1], one[2], other[2]
    shared = min(a.length, b.length)
    up, over = a.ancestor(shared), b.ancestor(shared)
    if up is over:
        x = a.ancestor(shared + 1).letter if a.length > shared else x
        y = b.ancestor(shared + 1).letter if b.length > shared else y
    else:
        while up.parent is not over.parent:
            up, over = (up.jump, over.jump) if up.jump is not over.jump else (up.parent, over.parent)
        x, y = up.letter, over.letter
    return one if x <= y else other


class Viterbi:
    """The search over one conversation; ``emit(letter, role, text)`` gets final edits in order."""

    def __init__(self, emit):
        self.emit, self.root = emit, _Node(None, "")
        self.survivors: dict[int, tuple[int, _Node]] = {}
        self._replace({START: (0, self.root)})

    def _replace(self, best: dict) -> None:
        """New survivors, inserted rows included; what nothing refers to goes."""
        for state in (START, SYSTEM, ENDED, USER):  # an insertion leads on from each
            if state in best:
                cost, node = best[state]
                self._offer(best, NEXT[state], (cost + INSERT, node, "I", NAMES[NEXT[state]], ""))
                best = self._linked(best, NEXT[state])
        ended = best[ENDED][0]
        if START in best and best[START][0] > ended + DELETE:
            del best[START]
        if SYSTEM in best and best[SYSTEM][0] > ended:
            del best[SYSTEM]
        for _, node in best.values():
            self._hold(node)
        for _, node in self.survivors.values():
            self._release(node)
        self.survivors = best

    @staticmethod
    def _offer(best: dict, state: int, edit: tuple) -> None:
        held = best.get(state)
        if held is None or edit[0] < held[0]:
            best[state] = edit
        elif edit[0] == held[0]:
            if len(held) == 2:
                node = held[1]
                held = (held[0], node.parent, node.letter, node.role, node.text)
                if _first_by_letters(held, edit) is held:
                    return
                best[state] = edit
            else:
                best[state] = _first_by_letters(held, edit)

    @staticmethod
    def _linked(best: dict, state: int) -> dict:
        held = best[state]
        if len(held) > 2:
            cost, parent, letter, role, text = held
            best[state] = (cost, _Node(parent, letter, role, text))
        return best

    @staticmethod
    def _hold(node: _Node) -> None:
        node.references += 1
        while node.references == 1 and node.parent is not None:
            node = node.parent
            node.references += 1

    @staticmethod
    def _release(node: _Node) -> None:
        node.references -= 1
        while node.references == 0 and node.parent is not None:
            node = node.parent
            node.references -= 1

    def row(self, role: str, text: str, must_go: bool, truncated: bool) -> None:
        best: dict = {}
        letter = role[:1]
        stays = CUT_SHORT if truncated else 0
        for state, (cost, node) in self.survivors.items():
            self._offer(best, state, (cost + DELETE, node, "D", None, None))
            if not must_go:
                kept = STEPS.get((state, letter)) if letter else state
                if kept is not None:
                    self._offer(best, kept, (cost + KEEP + stays, node, "K", role, text))
                self._offer(best, NEXT[state], (cost + REROLE + stays, node, "R", NAMES[NEXT[state]], text))
        for state in list(best):
            self._linked(best, state)
        self._replace(best)
        self._emit_shared()

    def _emit_shared(self) -> None:
        """Emit the edits that all survivors share."""
        if self.root.references != 1 or any(node is self.root for _, node in self.survivors.values()):
            return
        held = {id(node) for _, node in self.survivors.values()}
        node, path = next(iter(self.survivors.values()))[1], []
        while node is not self.root:
            path.append(node)
            node = node.parent
        while path and self.root.references == 1 and id(self.root) not in held:
            self.root = path.pop()
            self.root.parent = None
            self.emit(self.root.letter, self.root.role, self.root.text)

    def end(self) -> int:
        """Emit what is left of the best edits; returns their cost."""
        edits = [(self.survivors[s][0], self.survivors[s][1], "") for s in (START, ENDED) if s in self.survivors]
        least = min(e[0] for e in edits)
        edits = [e for e in edits if e[0] == least]
        chosen = edits[0] if len(edits) == 1 else _first_by_letters(*edits)
        node, path = chosen[1], []
        while node is not self.root:
            path.append(node)
            node = node.parent
        for node in reversed(path):
            self.emit(node.letter, node.role, node.text)
        return least


class _Conversation:
    """Counts over the rows of a conversation beside its search."""

    def __init__(self, emit):
        self.search = Viterbi(emit)
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.least = self.turn = self.before = None

    def row(self, turn, role, text, blank, repeated, truncated) -> None:
        if turn is not None and turn != self.turn:
            self.least = turn if self.least is None else self.least
            self.turn, self.turns = turn, self.turns + 1
        self.illegal += self.before is not None and self.before + role[:1] not in LEGAL
        self.before = role[:1]
        fault = "blank" if blank else "duplicate" if repeated else "truncated" if truncated else None
        if fault:
            setattr(self, fault, getattr(self, fault) + 1)
        self.search.row(role, text, blank or repeated, fault == "truncated")

    def end(self) -> tuple:
        cost = self.search.end()
        gaps = 0 if self.turn is None else self.turn - self.least + 1 - self.turns
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after the test damage that a hash of conversation and turn picks."""
    place = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(place.cast("binary")) % 20).alias("_ql_fault"))
    rows = rows.where("_ql_fault != 0").select(
        "conv_id", "turn",
        F.when(F.col("_ql_fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_ql_fault") == 1, "").when(F.col("_ql_fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("_ql_fault") == 3, 2).otherwise(1).alias("_ql_copies"),
    )
    return rows.withColumn("_ql_copy", F.explode(F.sequence(F.lit(1), "_ql_copies"))).drop("_ql_copies", "_ql_copy")


def _in_order(rows: DataFrame) -> DataFrame:
    """Rows with their faults, each conversation in order in one partition."""
    rows = rows.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")])
    same = Window.partitionBy("conv_id", "role", F.md5("text")).orderBy(F.col("turn").asc_nulls_first())
    marked = rows.withColumns({
        "_ql_place": F.row_number().over(same),
        "_ql_blank": F.col("text").rlike(BLANK),
        "_ql_truncated": F.col("text").rlike(TRUNCATED),
    }).withColumn("_ql_repeated", F.col("_ql_place") > 1)
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text", "_ql_place"]
    fields = ["conv_id", "turn", "role", "text", "_ql_blank", "_ql_repeated", "_ql_truncated"]
    return marked.repartition(n, "conv_id").sortWithinPartitions(*order).select(*fields)


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


REPORT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string"
)
REPAIRED = "conv_id long, place long, edit string, role string, text string"
FLUSH_ROWS = 2_000


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _arrow(spec: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in spec.split(", "))])


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema, out, conversation = _arrow(REPORT), [], None

    def opened():
        letters, digest = [], hashlib.sha256()

        def emit(letter, role, text):
            if role is not None:
                digest.update(f"{chr(10) if any_row else ''}{role}:{text}".encode())
                any_row.append(1) if not any_row else None
            letters.append(letter)

        any_row: list[int] = []
        return _Conversation(emit), letters, digest

    for conv_id, *row in _rows_of(batches):
        if conversation is None or conv_id != held:
            if conversation is not None:
                out.append((held, *conversation.end(), "".join(letters), digest.hexdigest()))
            held = conv_id
            conversation, letters, digest = opened()
            if len(out) >= FLUSH_ROWS:
                yield _batch(out, schema)
                out = []
        conversation.row(*row)
    if conversation is not None:
        out.append((held, *conversation.end(), "".join(letters), digest.hexdigest()))
        yield _batch(out, schema)


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema, out, conversation = _arrow(REPAIRED), [], None

    def opened(conv_id):
        count = 0

        def emit(letter, role, text):
            nonlocal count
            if role is not None:
                out.append((conv_id, count, letter, role, text))
                count += 1

        return _Conversation(emit)

    for conv_id, *row in _rows_of(batches):
        if conversation is None or conv_id != held:
            if conversation is not None:
                conversation.end()
            held, conversation = conv_id, opened(conv_id)
        conversation.row(*row)
        if len(out) >= FLUSH_ROWS:
            yield _batch(out, schema)
            out.clear()
    if conversation is not None:
        conversation.end()
    if out:
        yield _batch(out, schema)


def repaired(rows: DataFrame) -> DataFrame:
    """The repaired rows (conv_id, place, edit, role, text), places from 0."""
    return _in_order(rows).mapInArrow(_repaired, REPAIRED)


def repair_reports(rows: DataFrame) -> DataFrame:
    """One row per conversation: faults, cost, edits and a hash of the repaired rows."""
    return _in_order(rows).mapInArrow(_reports, REPORT)


def repair_all(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """The reports of ``rows`` for every conversation of ``conversations``, those without rows too."""
    ids = conversations.select(F.col("conv_id").cast("long").alias("_ql_id")).distinct()
    reports = repair_reports(rows)
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return ids.join(reports, F.col("_ql_id").eqNullSafe(reports["conv_id"]), "left").select(
        F.col("_ql_id").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
