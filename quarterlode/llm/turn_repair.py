"""Repair of conversations: the cheapest edits that leave alternating turns.

A conversation is in order if its roles are an optional system turn followed by pairs of user
and assistant, or nothing. A Viterbi search over the states of that pattern reads the rows of
a conversation once. Survivors are leaves of a tree of edits that counts the references to
each node; as soon as all survivors descend from one edit, the edits up to it are final and
leave the tree, so only unresolved edits are held. Of equally dear survivors the one whose
letters come first stays: their unresolved letters since the last common edit are compared.
A survivor that another one can follow, whatever comes, at less cost than its own is given up.
Deletions one behind the other are one node and hold no texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
USER, ASSISTANT = "user", "assistant"
# Where a turn with this initial leads, by state: before all turns, behind system, user and assistant.
START, SYSTEM, ASKED, ANSWERED = range(4)
MOVES = {(START, "s"): SYSTEM, (START, "u"): ASKED, (SYSTEM, "u"): ASKED, (ASKED, "a"): ANSWERED, (ANSWERED, "u"): ASKED}
WHOLE = (START, ANSWERED)
# Turns that may be inserted from a state: none, one or two, and the state they lead to. More never pay.
NEXT = {START: (USER, ASKED), SYSTEM: (USER, ASKED), ASKED: (ASSISTANT, ANSWERED), ANSWERED: (USER, ASKED)}
INSERTS = {
    state: [((), state), ((NEXT[state][0],), NEXT[state][1]), ((NEXT[state][0], NEXT[NEXT[state][1]][0]), NEXT[NEXT[state][1]][1])]
    for state in NEXT
}
# What it costs at most to do from the first state what the second one does, whatever rows come.
FOLLOW = {
    (ANSWERED, START): DELETE, (ANSWERED, SYSTEM): 0, (ANSWERED, ASKED): INSERT, (START, ANSWERED): 0, (START, SYSTEM): 0, (START, ASKED): INSERT,
    (SYSTEM, ASKED): INSERT, (ASKED, ANSWERED): INSERT, (ASKED, SYSTEM): INSERT, (ASKED, START): INSERT + DELETE,
}


class Turn(NamedTuple):
    """A row of a conversation, with its fault."""

    turn: int | None
    role: str | None
    text: str | None
    fault: str | None


class Edit(NamedTuple):
    """A letter of ``KRDI``, the role of the turn, its row (none for an inserted one) and the cost."""

    letter: str
    role: str | None
    row: Turn | None
    cost: int


class Node:
    """Edits one behind the other in the tree (several only if all delete), and who refers to them."""

    __slots__ = ("edits", "parent", "depth", "uses", "kids")

    def __init__(self, edit: Edit | None, parent: Node | None):
        self.edits, self.parent = [edit] if edit else [], parent
        self.depth = parent.depth + 1 if parent else 0
        self.uses, self.kids = 0, []
        if parent:
            parent.uses += 1
            parent.kids.append(self)

    def letters(self) -> str:
        return "".join(e.letter for e in self.edits)


def release(node: Node | None) -> None:
    """One reference less; nodes that nothing refers to leave the tree."""
    while node is not None:
        node.uses -= 1
        if node.uses or node.parent is None:
            return
        node.parent.kids.remove(node)
        node = node.parent


def comes_first(a: tuple[Node, str], b: tuple[Node, str]) -> bool:
    """Whether the letters of ``a``, a node and letters behind it, come before those of ``b``."""
    (x, left), (y, right) = a, b
    more, other = [left], [right]
    while x is not y:
        if x.depth >= y.depth:
            deep, x, kept = x, x.parent, more
        else:
            deep, y, kept = y, y.parent, other
        kept.append(deep.letters())
    return "".join(reversed(more)) < "".join(reversed(other))


class Survivors:
    """The cheapest edits into each state, for the rows so far."""

    def __init__(self):
        self.root = Node(None, None)
        self.root.uses = 1
        self.best: dict[int, tuple[int, Node]] = {START: (0, self.root)}

    def step(self, row: Turn | None) -> None:
        """Take one row, or none at the end: insert before it, then keep, rename or delete it."""
        found: dict[int, tuple[int, Node, list[Edit]]] = {}
        for state, (cost, node) in self.best.items():
            for roles, middle in INSERTS[state]:
                before = [Edit("I", role, None, INSERT) for role in roles]
                for edit, after in self._choices(row, middle):
                    edits = [*before, edit] if edit else before
                    total = cost + sum(e.cost for e in edits)
                    held = found.get(after)
                    if held is None or total < held[0] or total == held[0] and comes_first(
                        (node, "".join(e.letter for e in edits)), (held[1], "".join(e.letter for e in held[2]))):
                        found[after] = total, node, edits
        for state, (total, *_) in list(found.items()):
            if any(found[other][0] + extra < total for (other, own), extra in FOLLOW.items() if own == state and other in found):
                del found[state]
        made = {}
        for state, (total, node, edits) in found.items():
            alone = node.parent is not None and node.uses == 1 and sum(n is node for _, n, _ in found.values()) == 1
            if alone and len(edits) == 1 and edits[0].letter == node.edits[0].letter == "D":
                node.edits += edits
                node.depth += 1
            else:
                for edit in edits:
                    node = Node(edit, node)
            node.uses += 1
            made[state] = total, node
        for _, node in self.best.values():
            release(node)
        self.best = made

    @staticmethod
    def _choices(row: Turn | None, state: int) -> Iterator[tuple[Edit | None, int]]:
        if row is None:
            if state in WHOLE:
                yield None, state
            return
        yield Edit("D", row.role, row._replace(text=None), DELETE), state
        if row.fault in ("blank", "duplicate"):
            return
        extra = TRUNCATED if row.fault == "truncated" else 0
        initial = (row.role or "")[:1]
        if (state, initial) in MOVES:
            yield Edit("K", row.role, row, extra), MOVES[state, initial]
        for role in (USER, ASSISTANT):
            if (state, role[0]) in MOVES:
                yield Edit("R", role, row, REROLE + extra), MOVES[state, role[0]]

    def settled(self) -> Iterator[Edit]:
        """Edits that all survivors share, which leave the tree."""
        while self.root.uses == 1 and self.root.kids:
            self.root = self.root.kids[0]
            self.root.parent = None
            yield from self.root.edits
            self.root.edits = []

    def end(self) -> Iterator[Edit]:
        """The rest, with the cheapest way to a whole conversation."""
        self.step(None)
        (cost, node), *others = self.best.values()
        for more, other in others:
            if more < cost or more == cost and comes_first((other, ""), (node, "")):
                node, other, cost = other, node, more
            release(other)
        self.best = {START: (cost, node)}
        yield from self.settled()


def fault_of(text: str | None, duplicate: bool) -> str | None:
    """The first fault that holds: blank, duplicate, truncated."""
    rest = (text or "").rstrip(SPACES)
    if not rest:
        return "blank"
    return "duplicate" if duplicate else None if rest[-1] in ".!?" else "truncated"


def repair(rows: Iterator[tuple[int | None, str | None, str | None, bool]]) -> Iterator[Edit]:
    """Edits of one conversation, in order, each as soon as it is settled.

    A row is turn, role, text and whether the same role and text stand at an earlier turn.
    """
    search, last = Survivors(), None
    for turn, role, text, again in rows:
        again = again or last == (role, text)
        last = role, text
        search.step(Turn(turn, role, text, fault_of(text, again)))
        yield from search.settled()
    yield from search.end()


EDITS = "place bigint, edit string, cost bigint, turn bigint, old_role string, fault string, role string, text string"


def _by_conversation(rows: Iterator[tuple]) -> Iterator[tuple[object, Iterator[tuple]]]:
    """Conversations that come one behind the other, null as one of them."""
    row = next(rows, None)
    while row is not None:
        conv = row[0]

        def own() -> Iterator[tuple]:
            nonlocal row
            while row is not None and row[0] == conv:  # noqa: B023
                yield row[1:]
                row = next(rows, None)

        yield conv, own()


def _repaired(rows_per_batch: int):
    names = ["conv", *(x.split()[0] for x in EDITS.split(", "))]
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 4]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, out, held = pa.null(), [], 0

        def rows() -> Iterator[tuple]:
            nonlocal kind
            for batch in batches:
                kind = batch.schema.field(0).type
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        def pack() -> pa.RecordBatch:
            arrays = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), [kind, *types], strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names)

        for conv, own in _by_conversation(rows()):
            for place, e in enumerate(repair(own)):
                row = e.row or Turn(None, None, "", None)
                out.append((conv, place, e.letter, e.cost, row.turn, row.role, row.fault, e.role, row.text))
                held += len(row.text or "")
                if held > 1 << 20 or len(out) >= rows_per_batch:
                    yield pack()
                    out, held = [], 0
        if out:
            yield pack()

    return run


def _first_turns(rows: DataFrame) -> DataFrame:
    """Of role and text that stand more than once in a conversation: the first turn, as ``known, turn``."""
    keys = rows.groupBy("conv", "key").agg(F.min(F.struct("known", "turn")).alias("first"), F.count(F.lit(1)).alias("n"))
    return keys.where("n > 1").select(F.col("conv").alias("of"), F.col("key").alias("again"), "first")


def repaired_turns(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    rows_per_batch: int = 2000,
) -> DataFrame:
    """A row for each edit: ``conv_col``, ``EDITS``; a conversation's rows come one behind the other, in order.

    Edits are ``K`` keep (free), ``R`` give the role user or assistant (1), ``D`` delete (2) and ``I`` insert an empty
    turn (5); an undeleted truncated row costs 5 more. Rows are taken by turn (null first), role and text. Blank rows
    and those whose role and text stood before are deleted. ``old_role`` and ``turn`` are null for inserted turns;
    ``text`` is the row's, null if it is deleted. Null roles and texts count as empty ones; rows without a conversation are one conversation.
    Whole turns only: a turn number that is no integer is cut to one. Other columns are not looked at.

    A conversation is read by one task, row by row from a sort that can spill, as its edits depend on all before; the
    task holds the unsettled edits only. What stood before is found by a join on counted keys.
    """
    kind = rows.schema[conv_col].dataType.simpleString()
    flat = rows.select(rows[conv_col].alias("conv"), rows[turn_col].cast("bigint").alias("turn"), rows[role_col].alias("role"), rows[text_col].alias("text"))
    flat = flat.withColumns({
        "known": F.col("turn").isNotNull(),
        "key": F.struct(F.xxhash64("role", "text").alias("a"), F.xxhash64(F.lit("second"), "text", "role").alias("b"))})
    first = _first_turns(flat)
    joined = flat.join(first, flat["conv"].eqNullSafe(first["of"]) & (flat["key"] == first["again"]), "left")
    earlier = F.coalesce(F.col("first") < F.struct("known", "turn"), F.lit(False))
    ordered = (joined.select("conv", "turn", "role", "text", earlier.alias("again"))
               .repartition("conv").sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "text"))
    return ordered.mapInArrow(_repaired(rows_per_batch), f"conv {kind}, {EDITS}").withColumnRenamed("conv", conv_col)


SUMMARY = ("gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, "
           "repaired_sha256 string")
LEGAL = ("su", "ua", "au")


def summary(rows: Iterator[tuple]) -> tuple:
    """Counts and digests of one conversation from its edits."""
    faults = {"blank": 0, "duplicate": 0, "truncated": 0}
    gaps = turns = illegal = cost = 0
    low = last = before = None
    letters, text, lines = [], hashlib.sha256(), 0
    for _, edit, price, turn, old_role, fault, role, said in rows:
        letters.append(edit)
        cost += price
        if edit != "I":
            if fault:
                faults[fault] += 1
            if turn is not None:
                low, turns, last = turn if low is None else low, turns + (turn != last), turn
            initial = (old_role or "")[:1]
            illegal += before is not None and before + initial not in LEGAL
            before = initial
        if edit != "D":
            text.update((("\n" if lines else "") + f"{role or ''}:{said or ''}").encode())
            lines += 1
    gaps = 0 if low is None else last - low + 1 - turns
    return gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, "".join(letters), text.hexdigest()


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind, out = pa.null(), []
    names = ["conv", *(x.split()[0] for x in SUMMARY.split(", "))]

    def pack() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [()] * len(names)
        types = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    def rows() -> Iterator[tuple]:
        nonlocal kind
        for batch in batches:
            kind = batch.schema.field(0).type
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    for conv, own in _by_conversation(rows()):
        out.append((conv, *summary(own)))
        if len(out) >= 2000:
            yield pack()
            out = []
    if out:
        yield pack()


def summaries(edits: DataFrame) -> DataFrame:
    """A row for each conversation, from the rows of ``repaired_turns`` as they come from it."""
    first = edits.schema[0]
    return edits.mapInArrow(_summed, f"conv {first.dataType.simpleString()}, {SUMMARY}").withColumnRenamed("conv", first.name)
