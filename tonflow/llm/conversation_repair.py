"""Repair of conversation structure by the cheapest edits, with the audit of what was done.

A conversation's turns, in order, are kept, given another role, deleted or joined by inserted
empty turns until the roles read ``(s?(ua)+)?`` (s system, u user, a assistant).  Of the cheapest
edits those whose letters (D, I, K, R) are least in ASCII order win.  The letters of a
conversation say all: replayed on its turns, they give the repaired turns.

The dynamic program goes through the turns once.  For each of four states (nothing yet, after
s, after u, after a) it holds a cost and the last node of an audit.  Nodes are persistent: a
node knows its letter, its ancestors 1, 2, 4, ... letters back and a rolling hash of all
letters up to it, so audits share their prefixes and are extended without copying.  Audits of
equal cost are compared at the first letter after their longest common prefix, which is found by
lifting both through ancestors whose hashes differ.  One audit leads to one state, so audits
alike are one node: where hashes agree this is verified, and a collision counts as a difference.

What all four audits have in common is settled; it is replayed, its turns are handed out and the
nodes are dropped, so a task holds a window of a conversation, not the conversation.  (Where two
audits differ from their first letter on for good, as when every turn is a user's, the window grows
with the conversation.)

Defined results
  * Turns are ordered by turn (none first), role, text; rows alike are adjacent.
  * Null roles and texts count as one space.  A row without a conversation id belongs to the
    conversation without an id.
  * Conversations all of whose rows are marked absent have zeros and an empty audit.
  * The role is judged by its first character; an empty or other role is neither s, u nor a.
  * Earlier turns are known by a 128-bit digest of role and text; while a conversation is read,
    its task holds 16 bytes for each distinct turn.
  * Only the named columns are read; other columns may have any names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonflow.llm.common import code_on_workers, pieces

#: Costs of the edits, and what a truncated turn adds unless it is deleted.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
BLANKS = " \t\n\x0b\x0c\r"
CLOSING = ".!?"

START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
#: The state a kept turn leads to, by state and first letter of its role.
_KEPT = {(START, "s"): AFTER_SYSTEM, (START, "u"): AFTER_USER, (AFTER_SYSTEM, "u"): AFTER_USER,
         (AFTER_ASSISTANT, "u"): AFTER_USER, (AFTER_USER, "a"): AFTER_ASSISTANT}
#: The state a turn leads to that is given a role or inserted, and that role.
_NEXT = [AFTER_USER, AFTER_USER, AFTER_ASSISTANT, AFTER_USER]
_ROLE = ["user", "user", "assistant", "user"]

_BASE, _MODULUS = 1_000_003, (1 << 61) - 1
#: Letters of an audit that wait, at least, before the common part is looked for.
WINDOW = 2048


class Node:
    """The last letter of an audit."""

    __slots__ = ("depth", "letter", "hash", "up")

    def __init__(self, parent: Node | None, letter: str) -> None:
        self.letter = letter
        if parent is None:
            self.depth, self.hash, self.up = 0, 0, ()
            return
        self.depth = parent.depth + 1
        self.hash = (parent.hash * _BASE + ord(letter)) % _MODULUS
        up, k = [parent], 0
        while len(up[k].up) > k:
            up.append(up[k].up[k])
            k += 1
        self.up = tuple(up)

    def ancestor(self, depth: int) -> Node:
        node, back = self, self.depth - depth
        while back:
            k = back.bit_length() - 1
            node = node.up[k]
            back -= 1 << k
        return node

    def letters(self, after: Node) -> str:
        """Those that follow the ancestor ``after``."""
        out, node = [], self
        while node is not after:
            out.append(node.letter)
            node = node.up[0]
        return "".join(reversed(out))


def alike(a: Node, b: Node) -> bool:
    """Same letters up to these nodes; equal hashes alone prove nothing."""
    return a.hash == b.hash and a is b


def common_prefix(a: Node, b: Node) -> int:
    """Length of the longest common prefix of two audits."""
    depth = min(a.depth, b.depth)
    a, b = a.ancestor(depth), b.ancestor(depth)
    if alike(a, b):
        return depth
    for k in reversed(range(len(a.up))):
        if k < len(a.up) and not alike(a.up[k], b.up[k]):
            a, b = a.up[k], b.up[k]
    return a.depth - 1


def before(a: Node, first: str, b: Node, second: str) -> bool:
    """Audit ``a`` and the letter ``first`` come before audit ``b`` and ``second`` in ASCII order."""
    depth = common_prefix(a, b)
    x = a.ancestor(depth + 1).letter if depth < a.depth else first
    y = b.ancestor(depth + 1).letter if depth < b.depth else second
    if x != y:
        return x < y
    # One audit is the beginning of the other up to here: read both on letter by letter.
    root = a.ancestor(depth)
    return a.letters(root) + first < b.letters(root) + second


class Audit:
    """The dynamic program over the turns of one conversation."""

    def __init__(self) -> None:
        self.root = Node(None, "")
        self.cells: list[tuple[int, Node] | None] = [(0, self.root), None, None, None]
        self.waiting = WINDOW
        self._insert()

    def _offer(self, cells: list, state: int, cost: int, parent: Node, letter: str) -> None:
        held = cells[state]
        if held is None or cost < held[0] or (cost == held[0] and before(parent, letter, held[1], held[2])):
            cells[state] = (cost, parent, letter)

    def _insert(self) -> None:
        """Empty turns inserted here: at most a user and an assistant turn pay."""
        for into, sources in ((AFTER_USER, (START, AFTER_SYSTEM, AFTER_ASSISTANT)), (AFTER_ASSISTANT, (AFTER_USER,))):
            best = [None] * 4
            for state in sources:
                if self.cells[state] is not None:
                    cost, node = self.cells[state]
                    self._offer(best, into, cost + INSERT, node, "I")
            if best[into] is None:
                continue
            cost, parent, letter = best[into]
            held = self.cells[into]
            if held is None or cost < held[0]:
                self.cells[into] = (cost, Node(parent, letter))
            elif cost == held[0] and held[1].depth:
                if before(parent, letter, held[1].up[0], held[1].letter):
                    self.cells[into] = (cost, Node(parent, letter))

    def turn(self, initial: str, must_go: bool, truncated: bool) -> None:
        cells: list = [None] * 4
        extra = TRUNCATED if truncated else 0
        for state, cell in enumerate(self.cells):
            if cell is None:
                continue
            cost, node = cell
            self._offer(cells, state, cost + DELETE, node, "D")
            if must_go:
                continue
            kept = _KEPT.get((state, initial))
            if kept is not None:
                self._offer(cells, kept, cost + KEEP + extra, node, "K")
            self._offer(cells, _NEXT[state], cost + REROLE + extra, node, "R")
        self.cells = [None if c is None else (c[0], Node(c[1], c[2])) for c in cells]
        self._insert()
        self._drop_hopeless()

    def _drop_hopeless(self) -> None:
        """Whatever follows costs no more after an assistant turn; but only at the start may an s be kept.

        That s could be deleted instead.  Without this, the audit that has deleted all turns so far
        would be held for good and nothing settled.
        """
        ended = self.cells[AFTER_ASSISTANT]
        for state, ahead in ((START, DELETE), (AFTER_SYSTEM, 0)):
            cell = self.cells[state]
            if ended is not None and cell is not None and cell[0] > ended[0] + ahead:
                self.cells[state] = None

    def settle(self) -> str:
        """Letters that all audits begin with, if enough wait; they are forgotten."""
        live = [c[1] for c in self.cells if c is not None]
        if max(n.depth for n in live) < self.waiting:
            return ""
        shared = live[0]
        for node in live[1:]:
            shared = shared.ancestor(common_prefix(shared, node))
        settled = shared.letters(self.root)
        if settled:
            root, known = Node(None, ""), {}
            for state, cell in enumerate(self.cells):
                if cell is None:
                    continue
                node = root
                for letter in cell[1].letters(shared):
                    at = (id(node), letter)
                    known[at] = known.get(at) or Node(node, letter)
                    node = known[at]
                self.cells[state] = (cell[0], node)
            self.root = root
        self.waiting = max(WINDOW, 2 * max(c[1].depth for c in self.cells if c is not None))
        return settled

    def finish(self) -> tuple[int, str]:
        """Cost of the cheapest edits and their letters since the last settled one."""
        best: list = [None]
        for state in (START, AFTER_ASSISTANT):
            cell = self.cells[state]
            if cell is not None:
                cost, node = cell
                if node.depth:
                    self._offer(best, 0, cost, node.up[0], node.letter)
                elif best[0] is None or cost <= best[0][0]:
                    best[0] = (cost, self.root, "")
        cost, parent, letter = best[0]
        return cost, parent.letters(self.root) + letter


# ------------------------------------------------------------------------ conversations
class _Conversation:
    """One conversation while its turns pass by."""

    def __init__(self, key: object) -> None:
        self.key, self.audit, self.seen = key, Audit(), set()
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.first = self.last = None
        self.distinct = 0
        self.initial: str | None = None
        self.state, self.place = START, 0
        self.waiting: list[tuple[str, str]] = []
        self.letters: list[str] = []

    def add(self, turn: int | None, role: str, text: str) -> None:
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.distinct = turn, self.distinct + 1
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = initial
        core = text.strip(BLANKS)
        must_go = truncated = False
        if not core:
            self.blank += 1
            must_go = True
        else:
            mark = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
            if mark in self.seen:
                self.duplicate += 1
                must_go = True
            else:
                self.seen.add(mark)
                truncated = core[-1] not in CLOSING
                self.truncated += truncated
        self.audit.turn(initial, must_go, truncated)
        self.waiting.append((role, text))

    def replay(self, letters: str) -> Iterator[tuple[int, str, str, str]]:
        """(place, edit, role, text) of the repaired turns that these edits give."""
        self.letters.append(letters)
        turns = iter(self.waiting)
        used = 0
        for letter in letters:
            role, text = ("", "") if letter == "I" else next(turns)
            used += letter != "I"
            if letter == "D":
                continue
            if letter == "K":
                self.state = _KEPT[self.state, role[:1]]
            else:
                role, self.state = _ROLE[self.state], _NEXT[self.state]
            yield self.place, letter, role, text
            self.place += 1
        del self.waiting[:used]

    def summary(self, cost: int) -> dict:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.distinct
        return {
            "gaps": min(gaps, 2**63 - 1), "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated,
            "illegal": self.illegal, "cost": cost, "audit": "".join(self.letters),
        }


_SUMMARY = pa.struct(
    [(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [("audit", pa.string())]
)
_SUMMARY_TYPE = "struct<gaps:bigint,blank:bigint,duplicate:bigint,truncated:bigint,illegal:bigint,cost:bigint,audit:string>"
#: Rows and characters of one batch that is handed out.
_ROWS_OUT, _CHARS_OUT = 4096, 4 << 20


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", present: Column | None = None) -> DataFrame:
    """Repaired turns, and after those of a conversation one row with its summary.

    Columns: ``conv_id``, ``place`` (from 0), ``edit`` (K, R or I), ``role``, ``text``; on the last row of a
    conversation these four are null and ``summary`` holds gaps, blank, duplicate, truncated,
    illegal, cost and audit.  Rows of a conversation follow each other within a partition.  Rows that
    are not ``present`` only name their conversation.
    """
    code_on_workers(rows.sparkSession)
    here = F.lit(True) if present is None else F.coalesce(present, F.lit(False))
    turns = rows.select(
        F.col(conv).alias("conv_id"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"), here.alias("present"),
    )
    in_order = turns.repartition("conv_id").sortWithinPartitions(
        F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text"
    )
    kind = turns.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, place long, edit string, role string, text string, summary {_SUMMARY_TYPE}"
    return in_order.mapInArrow(_repair, schema)


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    chars, key_type, now = 0, None, None

    def done(conversation: _Conversation) -> Iterator[tuple]:
        cost, letters = conversation.audit.finish()
        for made in conversation.replay(letters):
            yield (conversation.key, *made, None)
        yield (conversation.key, None, None, None, None, conversation.summary(cost))

    def batch_out() -> pa.RecordBatch:
        columns = list(zip(*out))
        types = [key_type, pa.int64(), pa.string(), pa.string(), pa.string(), _SUMMARY]
        arrays = [pa.array(c, t) for c, t in zip(columns, types)]
        out.clear()
        return pa.RecordBatch.from_arrays(arrays, ["conv_id", "place", "edit", "role", "text", "summary"])

    for batch in pieces(batches, "text"):
        key_type = batch.schema.field("conv_id").type
        for key, turn, role, text, present in zip(*[batch.column(i).to_pylist() for i in range(5)]):
            made: list[tuple] = []
            if now is None or now.key != key:
                made = [] if now is None else list(done(now))
                now = _Conversation(key)
            if present:
                now.add(turn, role, text)
                letters = now.audit.settle()
                if letters:
                    made += [(now.key, *m, None) for m in now.replay(letters)]
            out += made
            chars += sum(len(m[4] or "") for m in made)
            if len(out) >= _ROWS_OUT or chars >= _CHARS_OUT:
                yield batch_out()
                chars = 0
    if now is not None:
        out += done(now)
        yield batch_out()


def digests(repaired: DataFrame) -> DataFrame:
    """``conv_id``, ``summary`` and ``repaired_sha256`` of what :func:`repair` returns, turn by turn.

    The digest is that of the lines ``role:text``, joined by newlines.  The rows of a conversation
    come in order from the step before, so none is held.
    """
    kind = repaired.schema["conv_id"].dataType.simpleString()
    return repaired.mapInArrow(_digests, f"conv_id {kind}, summary {_SUMMARY_TYPE}, repaired_sha256 string")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    running = hashlib.sha256()
    for batch in batches:
        last = batch.filter(pa.compute.is_valid(batch.column(5)))
        found = []
        for place, role, text in zip(*[batch.column(i).to_pylist() for i in (1, 3, 4)]):
            if place is None:
                found.append(running.hexdigest())
                running = hashlib.sha256()
            else:
                running.update(f"{chr(10) if place else ''}{role}:{text}".encode())
        if found:
            yield pa.RecordBatch.from_arrays(
                [last.column(0), last.column(5), pa.array(found)], ["conv_id", "summary", "repaired_sha256"]
            )
