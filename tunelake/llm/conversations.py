"""Repair of the turn structure of conversations by survivor-coalescence Viterbi.

A conversation is sound if the first letters of its roles read ``(s?(ua)+)?``. An automaton of four
states reads the repaired rows: nothing yet, after a system row, after a user row, after an assistant
row; it may end in the first or the last. The rows of a conversation pass in order, and each is kept
(free), given the role that fits (3), or deleted (4; a blank or duplicate row must be); a row without
text may be inserted anywhere (3); a truncated row that stays costs 3 more. For each state there is one
survivor, the cheapest way to reach it, of equal ones that with the least edits as a string of their
first letters (``D``, ``I``, ``K``, ``R``).

The edits of the survivors form a tree whose nodes count the branches that refer to them. A node that
nothing refers to goes, a node with one branch is merged with it, so the tree has at most seven nodes
and an edit takes one byte. What all survivors share, the top of the tree, is emitted at once with the
rows it belongs to; only rows whose edit is still open are held. A survivor that is dearer than another
one by more than any future could win back is given up, so that deleting everything does not stay open
for ever. Ties are settled by the whole open parts of both survivors, from where they part.

Equal cost never goes with one edit string being the beginning of another one: over the same rows the
longer one has more insertions. So the order of two tied survivors cannot turn later.

Rows are dealt out by conversation and sorted in each task (sorting spills); a conversation is read as
a stream, so memory is bounded by its open rows. The order of rows: by turn, nulls first, then by role
and text.

Defined results: a null role or text is one space; a null conversation is one of its own; a role that
begins with none of s, u, a, the empty one too, fits nowhere; repeated rows are duplicates; a
conversation without rows needs no edit; an empty table gives an empty table; other columns are left
out, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tunelake.llm.common import ROWS, small_batches
from tunelake.session import ship_package

RELABEL, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
SPACE = " \t\n\x0b\x0c\r"

#: States: nothing yet, after system, after user, after assistant.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_AFTER = {"s": _SYSTEM, "u": _USER, "a": _ASSISTANT}
_BEFORE = {_USER: (_START, _SYSTEM, _ASSISTANT), _ASSISTANT: (_USER,)}
#: What the rest may cost more from the first state than from the second one, at most.
_LOSS = (
    (0, 0, 3, 0),
    (6, 0, 3, 6),
    (7, 3, 0, 3),
    (4, 0, 3, 0),
)

Row = tuple  # turn, fault, role, text
Edit = tuple  # turn, fault, role before, edit, role, text


class Branch:
    """A stretch of edits; ``refs`` counts the branches that go on from its end."""

    __slots__ = ("parent", "edits", "refs")

    def __init__(self, parent: Branch | None, edits: bytes) -> None:
        self.parent, self.edits, self.refs = parent, bytearray(edits), 0
        if parent is not None:
            parent.refs += 1


Survivor = tuple[int, Branch, bytes]  # cost, branch, edits after it


def _line(branch: Branch) -> list[Branch]:
    """The branch and what it goes back to."""
    line = [branch]
    while line[-1].parent is not None:
        line.append(line[-1].parent)
    return line


def _precedes(a: Survivor, b: Survivor) -> bool:
    """Whether ``a`` is cheaper, or as cheap and its edits come first."""
    if a[0] != b[0]:
        return a[0] < b[0]
    if a[1] is b[1]:
        return a[2] < b[2]
    of_a, of_b = _line(a[1]), _line(b[1])
    while of_a and of_b and of_a[-1] is of_b[-1]:
        of_a.pop()
        of_b.pop()
    first = of_a[-1].edits if of_a else a[2], of_b[-1].edits if of_b else b[2]
    for x, y in zip(*first):  # where they part, mostly at once
        if x != y:
            return x < y
    whole = [b"".join([*(n.edits for n in reversed(line)), s[2]]) for line, s in ((of_a, a), (of_b, b))]
    return whole[0] < whole[1]


def _extended(survivor: Survivor | None, cost: int, edit: bytes) -> Survivor | None:
    return survivor and (survivor[0] + cost, survivor[1], survivor[2] + edit)


def _best(*candidates: Survivor | None) -> Survivor | None:
    best = None
    for candidate in candidates:
        if candidate and (best is None or _precedes(candidate, best)):
            best = candidate
    return best


def _with_insertions(s: list[Survivor | None]) -> list[Survivor | None]:
    """The survivors after as many insertions as help."""
    user = _best(s[_USER], *(_extended(s[state], INSERT, b"I") for state in _BEFORE[_USER]))
    return [s[_START], s[_SYSTEM], user, _best(s[_ASSISTANT], _extended(user, INSERT, b"I"))]


class Repair:
    """The repair of one conversation, row by row; ``add`` and ``end`` give the edits that are settled."""

    def __init__(self) -> None:
        self._top = Branch(None, b"")
        self._survivors: list[Survivor | None] = [(0, self._top, b""), None, None, None]
        self._open: deque[Row] = deque()
        self._state = _START

    def add(self, row: Row) -> Iterator[Edit]:
        self._open.append(row)
        _, fault, role, _ = row
        before = _with_insertions(self._survivors)
        after = [_extended(s, DELETE, b"D") for s in before]
        if fault not in ("blank", "duplicate"):
            more = TRUNCATED if fault == "truncated" else 0
            fits = _AFTER.get(role[:1])
            if fits == _SYSTEM:
                after[_SYSTEM] = _best(after[_SYSTEM], _extended(before[_START], more, b"K"))
            for state, sources in _BEFORE.items():
                edit = (more, b"K") if fits == state else (more + RELABEL, b"R")
                after[state] = _best(after[state], *(_extended(before[s], *edit) for s in sources))
        for state, own in enumerate(after):
            if own and any(s and s[0] + _LOSS[other][state] < own[0] for other, s in enumerate(after)):
                after[state] = None
        self._grow(after)
        yield from self._settle()

    def end(self) -> Iterator[Edit]:
        closed = _with_insertions(self._survivors)
        _, branch, edits = _best(closed[_START], closed[_ASSISTANT])
        rest = b"".join([*(n.edits for n in reversed(_line(branch))), edits])
        yield from self._emitted(rest)

    def _grow(self, after: list[Survivor | None]) -> None:
        """The new survivors as leaves of the tree; what leads to none of them goes."""
        old = {id(s[1]): s[1] for s in self._survivors if s}
        leaves = [s and (s[0], Branch(s[1], s[2])) for s in after]
        for branch in old.values():
            while branch is not None and not branch.refs:
                if branch.parent is not None:
                    branch.parent.refs -= 1
                branch = branch.parent
        for leaf in leaves:
            node = leaf and leaf[1]
            while node is not None and node.parent is not None:
                above = node.parent
                if above.refs == 1:  # the two are one stretch
                    above.edits += node.edits
                    node.edits, node.parent = above.edits, above.parent
                    if above is self._top:
                        self._top = node
                else:
                    node = above
        self._survivors = [leaf and (*leaf, b"") for leaf in leaves]

    def _settle(self) -> Iterator[Edit]:
        settled = bytes(self._top.edits)
        self._top.edits.clear()
        yield from self._emitted(settled)

    def _emitted(self, edits: bytes) -> Iterator[Edit]:
        for edit in edits.decode():
            turn, fault, was, text = (None, None, None, "") if edit == "I" else self._open.popleft()
            if edit == "D":
                yield turn, fault, was, edit, None, None
                continue
            role = was
            if edit != "K":
                role = "assistant" if self._state == _USER else "user"
            self._state = _AFTER[role[:1]]
            yield turn, fault, was, edit, role, text


def damaged(
    df: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Rows with faults put in by a checksum of conversation and turn: ``conv, turn, role, text``.

    One of 20 rows each goes, loses its text, loses its sentence marks, is there twice, becomes the
    user's. A row that goes leaves one without role and text, so that its conversation stays known.
    """
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (key, turn)]
    kind = F.crc32(F.concat(shown[0], F.lit(":"), shown[1])) % 20
    said = F.coalesce(F.col(text), F.lit(" "))
    row = F.struct(
        F.when(kind == 0, None).when(kind == 4, "user").otherwise(F.coalesce(F.col(role), F.lit(" "))).alias("role"),
        F.when(kind == 0, None)
        .when(kind == 1, "")
        .when(kind == 2, F.regexp_replace(said, "[.!?]", ""))
        .otherwise(said)
        .alias("text"),
    )
    rows = F.when(kind == 3, F.array(row, row)).otherwise(F.array(row))
    return df.select(F.col(key).alias("conv"), F.col(turn).cast("long").alias("turn"), F.inline(rows))


def _fault(text: Column, again: Column) -> Column:
    end = F.rtrim(text, F.lit(SPACE))
    return (
        F.when(end == "", "blank")
        .when(again, "duplicate")
        .when(~F.substring(end, -1, 1).isin(".", "!", "?"), "truncated")
    )


def in_order(rows: DataFrame) -> DataFrame:
    """Rows ``conv, turn, role, text`` with their ``fault``, conversations whole and in order."""
    by_turn = F.col("turn").asc_nulls_first()
    again = F.row_number().over(Window.partitionBy("conv", "role", "text").orderBy(by_turn)) > 1
    return (
        rows.select("conv", "turn", "role", "text")
        .repartition("conv")  # serves the window too
        .withColumn("again", again)
        .sortWithinPartitions("conv", by_turn, "role", "text", "again")
        .select("conv", "turn", _fault(F.col("text"), F.col("again")).alias("fault"), "role", "text")
    )


def _edits(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    columns: list[list] = [[] for _ in schema]

    def put(conv, place, edit: Edit) -> None:
        for column, cell in zip(columns, (conv, place, *edit)):
            column.append(cell)

    def batch() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
        for column in columns:
            column.clear()
        return made

    conv, repair, place, nothing = None, None, 0, (None,) * 6
    for part in small_batches(batches):
        for own, *row in zip(*(column.to_pylist() for column in part.columns)):
            if repair is None or own != conv:
                if repair:
                    for place, edit in enumerate(repair.end(), place):
                        put(conv, place, edit)
                conv, repair, place = own, Repair(), 0
                put(conv, None, nothing)
            if row[2] is not None:
                for edit in repair.add(tuple(row)):
                    put(conv, place, edit)
                    place += 1
            if len(columns[0]) >= ROWS:
                yield batch()
    if repair:
        for place, edit in enumerate(repair.end(), place):
            put(conv, place, edit)
    yield batch()


def repair(rows: DataFrame) -> DataFrame:
    """The edits that make the conversations of ``rows`` (conv, turn, role, text) sound.

    ``conv, place, turn, fault, was, edit, role, text``: in order and together in one task for each
    conversation, after a row that has only ``conv``. ``was`` is the role before; a deleted row has no
    role and text, an inserted one has no turn. Rows without a role are not looked at.
    """
    ship_package(rows.sparkSession)
    ordered = in_order(rows)
    text = [T.StructField(c, T.StringType()) for c in ("fault", "was", "edit", "role", "text")]
    schema = T.StructType(
        [ordered.schema["conv"], *(T.StructField(c, T.LongType()) for c in ("place", "turn")), *text]
    )
    arrow = to_arrow_schema(schema)
    return ordered.mapInArrow(lambda batches: _edits(batches, arrow), schema)


class _Report:
    """Counts and digests of the edits of one conversation."""

    def __init__(self) -> None:
        self.turns = [None, None, 0]  # first, last, different
        self.faults = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.illegal = self.cost = 0
        self.before = None
        self.audit, self.digest, self.said = bytearray(), hashlib.sha256(), False

    def add(self, edit: Edit) -> None:
        turn, fault, was, kind, role, text = edit
        self.audit += kind.encode()
        self.cost += {"K": 0, "R": RELABEL, "D": DELETE, "I": INSERT}[kind]
        if kind != "I":
            if turn is not None and turn != self.turns[1]:
                self.turns = [turn if self.turns[0] is None else self.turns[0], turn, self.turns[2] + 1]
            if fault:
                self.faults[fault] += 1
                self.cost += TRUNCATED if fault == "truncated" and kind != "D" else 0
            if self.before is not None and self.before + was[:1] not in ("su", "ua", "au"):
                self.illegal += 1
            self.before = was[:1]
        if kind != "D":
            self.digest.update(("\n" * self.said + f"{role}:{text}").encode())
            self.said = True

    def row(self) -> tuple:
        first, last, different = self.turns
        gaps = 0 if first is None else last - first + 1 - different
        return (gaps, *self.faults.values(), self.illegal, self.cost, self.audit.decode(), self.digest.hexdigest())


def report(edits: DataFrame, key: str = "conv_id") -> DataFrame:
    """One row for each conversation of ``repair``'s result: its faults, the cost, the edits, a digest."""
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    schema = T.StructType(
        [T.StructField(key, edits.schema["conv"].dataType), *(T.StructField(c, T.LongType()) for c in counts),
         T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())]
    )
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, current = None, None
        for part in batches:
            done = []
            for own, place, *edit in zip(*(column.to_pylist() for column in part.columns)):
                if place is None:  # a conversation begins
                    if current:
                        done.append((conv, *current.row()))
                    conv, current = own, _Report()
                else:
                    current.add(tuple(edit))
            yield pa.RecordBatch.from_pylist([dict(zip(arrow.names, r)) for r in done], arrow)
        if current:
            yield pa.RecordBatch.from_pylist([dict(zip(arrow.names, (conv, *current.row())))], arrow)

    return edits.mapInArrow(run, schema)
