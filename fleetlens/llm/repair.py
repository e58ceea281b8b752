"""Conversation repair: the cheapest edits that give a well-formed conversation.

A conversation is well-formed when its roles are user, assistant, user,
assistant, ..., after a system turn at most, or when it has no turns. Turns may
be kept, given another role, deleted, and empty ones inserted. A Viterbi search
over four states (nothing yet, system, user, assistant) finds the edits of least
cost, and among these the least string of edit initials.

Rows are dealt by conversation and sorted there, so each conversation streams
through one task without being gathered. Back-pointers form a tree whose leaves
are the survivors of the states and whose nodes hold edits and count what
refers to them: what no survivor refers to any more goes, and what all
survivors share is emitted. A survivor that another one can imitate and stay
cheaper is none. So memory holds only the stretch that is still open, one byte
an edit.

Which of two equally dear histories has the smaller edits is decided by their
complete open stretches. Survivors all end in the edit of the same row, so none
is the beginning of another, and whatever follows leaves their order as it is:
the order is carried on from row to row as a rank, and no stretch is read again.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Costs of edits and of a truncated turn that stays.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

START, SYSTEM, USER, ASSISTANT = range(4)
_NAMES = {USER: "user", ASSISTANT: "assistant"}
#: States by what may follow: a role's first letter and the state it leads to.
_NEXT = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
#: What it costs a state at most to go on like another one: a turn inserted first, a system
#: turn deleted instead of kept, two turns inserted at the end.
_CATCH_UP = {(START, SYSTEM): 2 * INSERT, (START, USER): INSERT + DELETE, (START, ASSISTANT): DELETE,
             (SYSTEM, START): 0, (SYSTEM, USER): INSERT, (SYSTEM, ASSISTANT): 0,
             (USER, ASSISTANT): INSERT, (ASSISTANT, USER): INSERT}
_BLANKS = " \t\n\x0b\x0c\r"
_LONGEST = (1 << 63) - 1

SUMMARY = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
TURNS = "conv_id long, place long, edit string, turn long, role string, text string"


def _inserted(state: int) -> list[tuple[str, int]]:
    """Insertions that may be worth while in a state: edits and the state after them.

    Three would end where one does.
    """
    out = [("", state)]
    for _ in range(2):
        edits, at = out[-1]
        out.append((edits + "I", ASSISTANT if at == USER else USER))
    return out


def steps(initial: str, fault: str) -> list[tuple[int, int, int, str]]:
    """(from, to, cost, edits) of a row with that role initial and fault: the best of every pair of states."""
    best = {}
    for state in _NEXT:
        for inserts, at in _inserted(state):
            paid, stays = INSERT * len(inserts), TRUNCATED if fault == "truncated" else 0
            ways = [(at, DELETE, "D")]
            if fault not in ("blank", "duplicate"):
                ways += [(to, stays, "K") for role, to in _NEXT[at].items() if role == initial]
                ways += [(to, REROLE + stays, "R") for to in _NEXT[at].values() if to in _NAMES]
            for to, cost, edit in ways:
                offer = (paid + cost, inserts + edit)
                best[state, to] = min(offer, best.get((state, to), offer))
    return [(a, b, cost, edits) for (a, b), (cost, edits) in best.items()]


class _Node:
    """Edits of a stretch that later nodes share."""

    __slots__ = ("edits", "parent", "children")

    def __init__(self, edits: bytes, parent: _Node | None):
        self.edits, self.parent, self.children = bytearray(edits), parent, []


class Survivors:
    """The best history of every state, as leaves of a tree of shared stretches."""

    def __init__(self):
        self.root = _Node(b"", None)
        self.leaf = {START: self.root}

    def step(self, chosen: dict[int, tuple[int, str]]) -> bytes:
        """Go on to ``state: (state before, edits)``; returns the edits that are settled by it."""
        heirs: dict[int, list[int]] = {}
        for state, (before, _) in chosen.items():
            heirs.setdefault(before, []).append(state)
        leaves = {}
        for before, node in self.leaf.items():
            states = heirs.get(before, [])
            if len(states) == 1:
                node.edits += chosen[states[0]][1].encode()
                leaves[states[0]] = node
            else:
                for state in states:
                    leaves[state] = _Node(chosen[state][1].encode(), node)
                    node.children.append(leaves[state])
        gone = [node for before, node in self.leaf.items() if before not in heirs]
        self.leaf = leaves
        self._release(gone)
        settled = bytes(self.root.edits)
        self.root.edits.clear()
        return settled

    def _release(self, gone: list[_Node]) -> None:
        """Take out what nothing refers to; a stretch with one successor becomes one with it."""
        left = []
        for node in gone:
            while not node.children:
                node.parent.children.remove(node)
                node = node.parent
            left.append(node)
        for node in left:
            while len(node.children) == 1:
                heir = node.children[0]
                node.edits += heir.edits
                node.children, heir.children = heir.children, []
                for child in node.children:
                    child.parent = node
                for state, leaf in self.leaf.items():
                    if leaf is heir:
                        self.leaf[state] = node

    def rest(self, state: int) -> bytes:
        """The open edits of a state's history."""
        node, out = self.leaf[state], []
        while node is not None:
            out.append(bytes(node.edits))
            node = node.parent
        return b"".join(reversed(out))

    def open_edits(self) -> int:
        """Edits held in memory."""
        nodes, held = [self.root], 0
        while nodes:
            node = nodes.pop()
            held += len(node.edits)
            nodes += node.children
        return held


_steps: dict[tuple[str, str], list] = {}


class Search:
    """Viterbi over one conversation's rows; costs, ranks and survivors by state."""

    def __init__(self):
        self.cost, self.rank, self.tree = {START: 0}, {START: 0}, Survivors()

    def add(self, initial: str, fault: str) -> tuple[bytes, dict[int, tuple[int, str]]]:
        """One more row: edits settled by it, and for each state the one before and the edits from there."""
        key = (initial if initial in ("s", "u", "a") else "", fault)
        if key not in _steps:
            _steps[key] = steps(*key)
        best: dict[int, tuple] = {}
        for before, to, cost, edits in _steps[key]:
            if before in self.cost:
                offer = (self.cost[before] + cost, self.rank[before], edits, before)
                if to not in best or offer < best[to]:
                    best[to] = offer
        # A history that another one can follow and stay cheaper will not win.
        lost = [a for (a, b), more in _CATCH_UP.items() if a in best and b in best and best[b][0] + more < best[a][0]]
        best = {state: offer for state, offer in best.items() if state not in lost}
        order = sorted(best, key=lambda s: best[s][1:3])
        self.rank = {state: i for i, state in enumerate(order)}
        self.cost = {state: offer[0] for state, offer in best.items()}
        chosen = {state: (offer[3], offer[2]) for state, offer in best.items()}
        return self.tree.step(chosen), chosen

    def end(self) -> tuple[int, int, str]:
        """Cost, state and last insertions of the best history."""
        last = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
        cost, _, state = min((self.cost[s] + INSERT * len(last[s]), self.rank[s], s) for s in self.cost)
        return cost, state, last[state]


def written(state: int, edits: str, role: str, text: str) -> tuple[int, list[tuple[str, str, str]]]:
    """The state after ``edits`` of a row and the (edit, role, text) turns they give."""
    turns = []
    for edit in edits:
        if edit == "D":
            turns.append((edit, None, None))
            continue
        if edit == "K":
            state, to = _NEXT[state][role[:1]], role
        else:
            state = ASSISTANT if state == USER else USER
            to = _NAMES[state]
        turns.append((edit, to, "" if edit == "I" else text))
    return state, turns


def fault_of(text: str, repeated: bool) -> str:
    held = text.rstrip(_BLANKS)
    return "blank" if not held else "duplicate" if repeated else "truncated" if held[-1] not in ".!?" else ""


class _Conversation:
    """What a conversation's rows have shown so far."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.search = conv_id, Search()
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal, self.turns, self.low, self.high = 0, 0, None, None
        self.last = None

    def see(self, turn: int | None, role: str, text: str, repeated: bool) -> tuple[bytes, dict]:
        repeated = repeated or self.last == (turn, role, text)
        if self.last and self.last[1][:1] + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        if turn is not None and (self.high is None or turn != self.high):
            self.low = turn if self.low is None else self.low
            self.high, self.turns = turn, self.turns + 1
        self.last = (turn, role, text)
        fault = fault_of(text, repeated)
        if fault:
            self.faults[fault] += 1
        return self.search.add(role[:1], fault)

    def summary(self, cost: int) -> tuple:
        gaps = 0 if self.high is None else min(self.high - self.low + 1 - self.turns, _LONGEST)
        return self.conv_id, gaps, *self.faults.values(), self.illegal, cost


class _Digest:
    """A conversation with the digest of every state's repaired turns, so that no text is held."""

    def __init__(self, conv_id: int | None):
        self.all, self.audit = _Conversation(conv_id), bytearray()
        self.sha = {START: hashlib.sha256()}

    def row(self, turn, role, text, repeated) -> Iterator[tuple]:
        settled, chosen = self.all.see(turn, role, text, repeated)
        self.audit += settled
        self.sha = {state: self._more(before, edits, role, text) for state, (before, edits) in chosen.items()}
        return iter(())

    def _more(self, state: int, edits: str, role: str, text: str):
        sha = self.sha[state]
        if edits == "D":
            return sha
        sha = sha.copy()
        for edit, to, said in written(state, edits, role, text)[1]:
            if edit != "D":
                sha.update(f"{to}:{said}".encode() if state == START else f"\n{to}:{said}".encode())
                state = None
        return sha

    def end(self) -> Iterator[tuple]:
        cost, state, last = self.all.search.end()
        self.audit += self.all.search.tree.rest(state) + last.encode()
        yield *self.all.summary(cost), self.audit.decode(), self._more(state, last, "", "").hexdigest()


class _Repaired:
    """A conversation whose rows wait until their edits are settled."""

    def __init__(self, conv_id: int | None):
        self.all, self.waiting, self.state, self.place = _Conversation(conv_id), deque(), START, 0

    def _out(self, edits: bytes) -> Iterator[tuple]:
        for edit in edits.decode():
            turn, role, text = (None, None, None) if edit == "I" else self.waiting.popleft()
            self.state, ((_, to, said),) = written(self.state, edit, role or "", text or "")
            yield self.all.conv_id, self.place, edit, turn, role if edit == "D" else to, text if edit == "D" else said
            self.place += 1

    def row(self, turn, role, text, repeated) -> Iterator[tuple]:
        self.waiting.append((turn, role, text))
        return self._out(self.all.see(turn, role, text, repeated)[0])

    def end(self) -> Iterator[tuple]:
        _, state, last = self.all.search.end()
        return self._out(self.all.search.tree.rest(state) + last.encode())


def _ready(turns: DataFrame) -> DataFrame:
    """Rows dealt by conversation and sorted, with ``repeated``: an earlier turn has the same role and text.

    Repetitions are found by grouping digests over all rows, not by a set a conversation.
    """
    blank = F.lit(" ")
    held = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"),
                        (F.col("present") if "present" in turns.columns else F.lit(True)).alias("present"))
    said = F.unhex(F.sha2(F.concat(F.length("role"), F.lit(":"), "role", "text"), 256)).alias("said")
    at = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    rows = held.withColumn("said", said)
    first = rows.where("present").groupBy("conv_id", "said").agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    first = first.select(F.col("conv_id").alias("of"), F.col("said").alias("what"), "first")
    marked = rows.join(first, F.expr("conv_id <=> of AND said = what"), "left").select(
        "conv_id", "turn", "role", "text", "present", F.coalesce(at > F.col("first"), F.lit(False)).alias("repeated"))
    return marked.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")


def _streamed(turns: DataFrame, kind: type, schema: str) -> DataFrame:
    empty = turns.sparkSession.createDataFrame([], schema)
    fields = pa.schema([(f.name, pa.int64() if f.dataType.typeName() == "long" else pa.string()) for f in empty.schema])

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), fields)], schema=fields)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, out, held = None, [], 0
        for part in batches:
            for conv_id, turn, role, text, present, repeated in zip(*(c.to_pylist() for c in part.columns)):
                if open_ is None or open_.all.conv_id != conv_id:
                    if open_ is not None:
                        out += open_.end()
                    open_ = kind(conv_id)
                if present:
                    out += open_.row(turn, role, text, repeated)
                    held += len(text)
                if len(out) >= 1000 or out and held >= 1 << 22:
                    yield batch(out)
                    out, held = [], 0
        if open_ is not None:
            out += open_.end()
        if out:
            yield batch(out)

    return _ready(turns).mapInArrow(run, schema)


def summaries(turns: DataFrame) -> DataFrame:
    """One row a conversation: SUMMARY's columns.

    ``turns`` needs conv_id, turn, role and text, and may have ``present``: rows
    where it is false only name their conversation. Other columns are ignored.
    Rows are taken by turn, nulls first, those of one turn by role and text; a
    null role or text counts as one blank, a null conv_id is a conversation. A
    row's first fault counts: blank; duplicate, where role and text were seen
    earlier; truncated, where the last character that is no white space ends no
    sentence. Repeated rows are duplicates. A conversation without present rows
    has zeros and an empty audit; an empty table gives no rows.
    """
    return _streamed(turns, _Digest, SUMMARY)


def repaired(turns: DataFrame) -> DataFrame:
    """One row an edit, in order of ``place``: TURNS' columns, deleted rows as they were.

    Takes ``turns`` like ``summaries``. A row waits until all survivors share
    its edit, so texts of the open stretch are held.
    """
    return _streamed(turns, _Repaired, TURNS)


def damaged(turns: DataFrame) -> DataFrame:
    """Rows with faults by the crc32 of ``conv_id:turn`` (nulls: one blank) modulo 20.

    0 drops the row (``present`` is false), 1 empties its text, 2 removes its
    sentence ends, 3 repeats it, 4 makes the user its speaker. Null roles and
    texts become one blank first.
    """
    blank = F.lit(" ")

    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), blank)

    rows = turns.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"),
                        (F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20).alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("fault") != 0).alias("present"),
                       F.explode(copies).alias("copy")).drop("copy")
