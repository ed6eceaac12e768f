"""Repair of conversation structure by a Viterbi search with survivor coalescence.

A conversation is ``(system? (user assistant)+)?`` by the initials of its roles.
Its turns are read in order; the cheapest edits (keep, re-role, delete, insert)
are found over the four states of that grammar: nothing yet, after a system, a
user, an assistant turn. Every state has one survivor, a leaf of a tree of
backpointers whose nodes count what hangs on them. A node that loses its last
child is freed; as soon as all survivors share an ancestor, the edits up to it
are final and leave the tree. What is held is the unresolved end only. Of equally
cheap ways to a state the one with the least string of edit initials survives:
both strings are compared back to where they part. Neither can begin the other,
as more inserts cost more, so the comparison stands whatever follows.

Rows are dealt by conversation and sorted within the partition, where sorting
spills; they pass a task one by one, however long the conversation is. Which
(role, text) comes again is found before, by counts of digests over all rows.

Defined results: a null role or text is one space; null turns come first, null
ids are one conversation; rows of one turn are ordered by role and text; equal
rows of one turn are duplicates but for the first; a role without the initial
s, u or a (also an empty one) can't be kept; an empty table gives no rows; other
columns aren't read.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedkiln.llm.common import fields

#: States: nothing yet, after system, user, assistant. Where user and assistant lead.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT_ROLE = {START: (USER, "user"), SYSTEM: (USER, "user"), USER: (ASSISTANT, "assistant"), ASSISTANT: (USER, "user")}
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
LEGAL = {"su", "ua", "au"}
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
#: Repeated (conversation, role, text) that are sent to all tasks at most.
SMALL = 100_000

_VISIBLE = re.compile(r"[^\x20\x09-\x0D]")
_LAST = re.compile(r"[.!?][\x20\x09-\x0D]*\Z")


class Node:
    """An edit that a survivor's way made; ``row`` counts the rows read before it."""

    __slots__ = ("up", "edit", "row", "role", "depth", "children")

    def __init__(self, up: Node | None, edit: str, row: int, role: str | None):
        self.up, self.edit, self.row, self.role = up, edit, row, role
        self.depth = up.depth + 1 if up else 0
        self.children: list[Node] = []


class Survivors:
    """The search over one conversation. ``final(edit, role, text)`` is called
    for every edit as soon as it is certain, in order."""

    def __init__(self, final: Callable[[str, str | None, str | None], None]):
        self.final = final
        self.root = Node(None, "", 0, None)
        self.best: list[tuple[int, Node] | None] = [(0, self.root), None, None, None]
        self.rows: deque[tuple[str, str]] = deque()
        self.first_row = self.read = 0

    def less(self, x: tuple[Node, str], y: tuple[Node, str]) -> bool:
        """Whether one string of edits, given by its last edit and what is before it, is less."""
        (a, last_a), (b, last_b) = x, y
        if a is b:
            return last_a < last_b
        while a is not b:
            if a.depth >= b.depth:
                last_a, a = a.edit, a.up
            else:
                last_b, b = b.edit, b.up
        return last_a < last_b

    def better(self, new: tuple[int, Node, str, str | None], old: tuple[int, Node, str, str | None] | None) -> bool:
        if old is None or new[0] != old[0]:
            return old is None or new[0] < old[0]
        return self.less(new[1:3], old[1:3])

    def relax(self) -> None:
        """Inserts before the next row: two in a row at most lead to a new state."""
        for source, target in ((START, USER), (SYSTEM, USER), (ASSISTANT, USER), (USER, ASSISTANT)):
            if self.best[source] is None:
                continue
            cost, node = self.best[source]
            role = NEXT_ROLE[source][1]
            old = self.best[target]
            if old is not None:
                if cost + 5 > old[0] or (cost + 5 == old[0] and not self.less((node, INSERT), (old[1].up, old[1].edit))):
                    continue
            self.best[target] = (cost + 5, self.grow(node, INSERT, role))
            if old is not None and not any(b is not None and b[1] is old[1] for b in self.best):
                self.free(old[1])

    def grow(self, up: Node, edit: str, role: str | None) -> Node:
        node = Node(up, edit, self.read, role)
        up.children.append(node)
        return node

    def free(self, node: Node) -> None:
        """Drop a node that no survivor stands on, and what hung on it alone."""
        held = {id(b[1]) for b in self.best if b is not None}
        while not node.children and node is not self.root and id(node) not in held:
            up = node.up
            up.children.remove(node)
            node = up

    def add(self, role: str, text: str, must_go: bool, truncated: bool) -> None:
        """The next row: its role and text, whether only deletion is open to it,
        and whether it is truncated."""
        self.relax()
        self.rows.append((role, text))
        new: list[tuple[int, Node, str, str | None] | None] = [None] * 4
        extra = 5 if truncated else 0
        for state, held in enumerate(self.best):
            if held is None:
                continue
            cost, node = held
            ways = [(state, cost + 2, DELETE, None)]
            if not must_go:
                kept = KEPT.get((state, role[:1]))
                if kept is not None:
                    ways.append((kept, cost + extra, KEEP, role))
                target, name = NEXT_ROLE[state]
                ways.append((target, cost + extra + 1, REROLE, name))
            for target, price, edit, name in ways:
                way = (price, node, edit, name)
                if self.better(way, new[target]):
                    new[target] = way
        old = {id(b[1]): b[1] for b in self.best if b is not None}
        self.best = [None if w is None else (w[0], self.grow(w[1], w[2], w[3])) for w in new]
        self.read += 1
        for node in old.values():
            self.free(node)
        self.prune()
        self.settle()

    def prune(self) -> None:
        """Drop survivors that are dearer than another whatever follows. What
        follows nothing also follows an assistant turn, once a kept system turn is
        deleted instead (2); what follows a system turn follows either; a user
        turn is an insert (5) away from an assistant turn."""
        cost = [b[0] if b is not None else float("inf") for b in self.best]
        low = min(cost[ASSISTANT], cost[USER] + 5)
        for state, beaten in ((START, low + 2 < cost[START]), (SYSTEM, min(low, cost[START]) < cost[SYSTEM])):
            if beaten and self.best[state] is not None:
                node = self.best[state][1]
                self.best[state] = None
                self.free(node)

    def settle(self) -> None:
        """Hand out the edits that all survivors share."""
        held = {id(b[1]) for b in self.best if b is not None}
        while len(self.root.children) == 1 and id(self.root) not in held:
            child = self.root.children[0]
            self.emit(child)
            child.up = None
            self.root = child

    def emit(self, node: Node) -> None:
        while self.first_row < node.row:
            self.rows.popleft()
            self.first_row += 1
        self.final(node.edit, node.role, "" if node.edit == INSERT else self.rows[0][1])

    def end(self) -> int:
        """The cost of the cheapest complete repair, whose last edits are handed out."""
        self.relax()
        ways = [b for b in (self.best[START], self.best[ASSISTANT]) if b is not None]
        win = ways[0]
        for other in ways[1:]:
            if other[0] < win[0] or (other[0] == win[0] and other[1] is not win[1] and self.whole_less(other[1], win[1])):
                win = other
        path = []
        node = win[1]
        while node is not self.root:
            path.append(node)
            node = node.up
        for node in reversed(path):
            self.emit(node)
        return win[0]

    def whole_less(self, a: Node, b: Node) -> bool:
        if a is self.root or b is self.root:
            return a is self.root
        return self.less((a.up, a.edit), (b.up, b.edit))


class Conversation:
    """Faults of the rows of one conversation, and their repair."""

    def __init__(self, ident, final: Callable[[str, str | None, str | None], None]):
        self.ident = ident
        self.search = Survivors(final)
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.last_turn = None
        self.last: tuple | None = None

    def add(self, turn, role: str, text: str, seen: bool) -> None:
        again = seen or (self.last is not None and self.last == (turn, role, text))
        if self.last is not None:
            self.illegal += self.last[1][:1] + role[:1] not in LEGAL
        self.last = (turn, role, text)
        if turn is not None:
            if self.low is None:
                self.low = turn
            self.turns += turn != self.high
            self.high = turn
        blank = not _VISIBLE.search(text)
        truncated = not blank and not again and not _LAST.search(text)
        self.blank += blank
        self.duplicate += again and not blank
        self.truncated += truncated
        self.search.add(role, text, blank or again, truncated)

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


def ordered(turns: DataFrame, ident: str, turn: str, role: str, text: str, copies: str | None) -> DataFrame:
    """Rows of a conversation together and in order, with ``_seen`` (role and
    text come in an earlier turn) and ``_copies``."""
    rows = turns.select(F.col(ident).alias("_id"), F.col(turn).alias("_turn"), F.coalesce(F.col(role), F.lit(" ")).alias("_role"),
                        F.coalesce(F.col(text), F.lit(" ")).alias("_text"), (F.col(copies) if copies else F.lit(1)).cast("int").alias("_copies"))
    rows = rows.withColumn("_key", F.sha2(F.to_json(F.struct("_id", F.col("_role").alias("r"), F.col("_text").alias("t")), {"ignoreNullFields": "false"}), 256))
    place = F.struct(F.col("_turn").isNotNull().alias("known"), "_turn")  # nulls first
    again = (rows.filter("_copies > 0").groupBy("_key").agg(F.count(F.lit(1)).alias("_n"), F.min(place).alias("_from"))
             .filter("_n > 1").select("_key", "_from")).checkpoint()
    joined = rows.join(F.broadcast(again) if again.count() <= SMALL else again, "_key", "left")
    seen = F.coalesce(place > F.col("_from"), F.lit(False))
    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (joined.select("_id", "_turn", "_role", "_text", "_copies", seen.alias("_seen")).repartition(n, "_id")
            .sortWithinPartitions("_id", F.col("_turn").asc_nulls_first(), "_role", "_text"))


def _conversations(batches: Iterator[pa.RecordBatch], begin: Callable, done: Callable) -> Iterator:
    """Feed sorted rows to one conversation after the other; ``done`` gives what
    each yields, ``None`` stands between batches."""
    now: Conversation | None = None
    for batch in batches:
        for ident, turn, role, text, copies, seen in zip(*[batch[c].to_pylist() for c in ("_id", "_turn", "_role", "_text", "_copies", "_seen")], strict=True):
            if now is None or now.ident != ident:
                if now is not None:
                    done(now)
                now = begin(ident)
            for _ in range(copies):
                now.add(turn, role, text, seen)
        yield now
    if now is not None:
        done(now)
    yield None


def _report(batches: Iterator[pa.RecordBatch], kind: pa.DataType, ident: str) -> Iterator[pa.RecordBatch]:
    names = [ident, "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    kinds = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
    rows: list[tuple] = []
    audit, sha, some = bytearray(), hashlib.sha256(), False

    def begin(x) -> Conversation:
        nonlocal sha, some
        audit.clear()
        sha, some = hashlib.sha256(), False
        return Conversation(x, final)

    def final(edit: str, role: str | None, text: str) -> None:
        nonlocal some
        audit.extend(edit.encode())
        if edit != DELETE:
            sha.update((("\n" if some else "") + f"{role}:{text}").encode())
            some = True

    def done(c: Conversation) -> None:
        cost = c.search.end()
        rows.append((c.ident, c.gaps, c.blank, c.duplicate, c.truncated, c.illegal, cost, audit.decode(), sha.hexdigest()))

    for _ in _conversations(batches, begin, done):
        yield pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)
        rows.clear()


def report(turns: DataFrame, ident: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", copies: str | None = None) -> DataFrame:
    """One row per conversation: faults, the cost of the cheapest repair, its
    edits and the digest of what it leaves. ``copies`` names a column that tells
    how often a row stands there (0: the conversation is reported without it)."""
    from pyspark.sql.pandas.types import to_arrow_type
    kind = to_arrow_type(turns.schema[ident].dataType)
    schema = T.StructType([*fields(turns, ident), *[T.StructField(c, T.LongType()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                           T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])
    return ordered(turns, ident, turn, role, text, copies).mapInArrow(lambda it: _report(it, kind, ident), schema)


def _repair(batches: Iterator[pa.RecordBatch], kind: pa.DataType, names: list[str]) -> Iterator[pa.RecordBatch]:
    kinds = [kind, pa.int64(), pa.string(), pa.string(), pa.string()]
    rows: list[tuple] = []
    ident, place = None, 0

    def begin(x) -> Conversation:
        nonlocal ident, place
        ident, place = x, 0
        return Conversation(x, final)

    def final(edit: str, role: str | None, text: str) -> None:
        nonlocal place
        if edit != DELETE:
            rows.append((ident, place, role, text, edit))
            place += 1

    for _ in _conversations(batches, begin, lambda c: c.search.end()):
        yield pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)
        rows.clear()


def repair(turns: DataFrame, ident: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", copies: str | None = None) -> DataFrame:
    """The repaired conversations: id, place from 0, role, text, and the edit
    (K, R or I) that each row comes from."""
    from pyspark.sql.pandas.types import to_arrow_type
    kind = to_arrow_type(turns.schema[ident].dataType)
    names = [ident, "place", "role", "text", "edit"]
    schema = T.StructType([*fields(turns, ident), T.StructField("place", T.LongType()), *[T.StructField(c, T.StringType()) for c in names[2:]]])
    return ordered(turns, ident, turn, role, text, copies).mapInArrow(lambda it: _repair(it, kind, names), schema)


def damage(turns: DataFrame, ident: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", copies: str = "copies") -> DataFrame:
    """Known faults for the repair to find, dealt by the row's id and turn: of
    twenty rows one is dropped (``copies`` 0), emptied, left without ``.!?``, there
    twice, or a user's. Null ids, turns, roles and texts count as one space."""
    bare = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(bare(ident), F.lit(":"), bare(turn))) % 20
    return turns.select(
        ident, turn, F.when(kind == 4, "user").otherwise(bare(role)).alias(role),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(bare(text), "[.!?]", "")).otherwise(bare(text)).alias(text),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias(copies))
