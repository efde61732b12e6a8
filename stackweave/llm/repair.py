"""Repair of conversation structure by a Viterbi search whose survivors coalesce.

A sound conversation is empty, or one optional system turn and then pairs of a user and an
assistant turn. Rows are kept (0), given the other role (2), deleted (3) or preceded by an
inserted empty turn (2); a blank row or one that repeats an earlier role and text must go, and a
truncated row that stays costs 1. The cheapest edits win, and of these the ones whose letters
(D, I, K, R) come first in ASCII order.

The search keeps one survivor for each state of the pattern (nothing yet, system, user,
assistant). Survivors share a tree of backpointers with reference counts: a node that no
survivor needs is freed at once, and as soon as all survivors hang from one node, the edits up to
it are final and leave the tree. Ties compare the whole unresolved suffixes, from the last common
ancestor on. A survivor that another one beats whatever follows is dropped, so that the tree
usually holds a few rows, however long the conversation is; a row that stays unresolved takes a
byte a survivor, and every row the same time.

Two passes. ``plan`` shuffles a narrow row for each turn (no text: a digest, the role's initial
and flags) and finds the edits. ``apply`` shuffles the texts once, with a conversation's edits in
front of its rows, and lays the repaired turns out one by one. Both stream sorted rows: a
conversation of any length passes through a task without being held, and Spark's sort spills. The
edits of a conversation are one text, one letter a row. Its rows must meet in order somewhere, as
its digest is a sequential hash, so one conversation is not split.

Rows are ordered by turn (nulls first), then role, then the SHA-256 of the text. Defined cases: a
null role or text is one space, so such a text is blank and such a role illegal. An empty role has
no initial and is illegal too. The null conv_id is a conversation of its own. Equal rows are
repeats of the first of them. Gaps beyond a long are the largest long. Columns other than the four
take no part. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stackweave import session
from stackweave.llm import common

REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {USER: "user", ASSISTANT: "assistant"}
# Which state a kept row of a role leads to, and from where; an inserted turn likewise.
_KEEP = {"s": ((EMPTY, SYSTEM),), "u": ((EMPTY, USER), (SYSTEM, USER), (ASSISTANT, USER)), "a": ((USER, ASSISTANT),)}
_TURNS = _KEEP["u"] + _KEEP["a"]
# A state's survivor is beaten for good when another one is cheaper by more than this: what the
# other must add at most to end in the same way. From an assistant turn a user turn may follow as
# after nothing, but a system turn that could still be kept has to be deleted.
_BRIDGE = {
    (EMPTY, ASSISTANT): DELETE, (EMPTY, USER): INSERT + DELETE, (SYSTEM, ASSISTANT): 0, (SYSTEM, EMPTY): 0,
    (SYSTEM, USER): INSERT, (USER, ASSISTANT): INSERT, (ASSISTANT, USER): INSERT, (EMPTY, SYSTEM): DELETE + 2 * INSERT,
}
_SOUND_PAIRS = ("su", "ua", "au")
_MOST = 2**63 - 1
FIELDS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


class Node:
    """A backpointer with the edits of the rows since its parent, where paths part."""

    __slots__ = ("parent", "edits", "uses")

    def __init__(self, parent: Node | None, edits: bytes):
        self.parent, self.edits, self.uses = parent, bytearray(edits), 1


class Search:
    """The survivors of one conversation; edits that are final are in ``done``.

    ``uses`` of a node counts its children and the survivor that ends there, if one does. A
    survivor with a single heir lengthens its own node, so nodes are made only where paths part.

    Of two paths to one state at one cost neither is a prefix of the other, as the longer one would
    hold more insertions: the first difference of their unresolved suffixes decides. What the
    comparison of two survivors' complete suffixes gave is kept in ``order`` and carried on with
    every row: -1 or 1 once they differ, else the insertions that the longer one has more.
    """

    def __init__(self) -> None:
        self.root, self.done = Node(None, b""), bytearray()
        self.alive: dict[int, tuple[int, Node]] = {EMPTY: (0, self.root)}
        self.order: dict[tuple[int, int], int | tuple[bytes, bytes]] = {}
        self._settle({EMPTY: (0, EMPTY, b"")})

    def row(self, initial: str, fault: str) -> None:
        """Take one row: its role's initial, and blank, duplicate, truncated or nothing as fault."""
        best: dict[int, tuple[int, int, bytes]] = {}
        late = TRUNCATED if fault == "truncated" else 0
        for state, (cost, _) in self.alive.items():
            self._offer(best, state, cost + DELETE, state, b"D")
        if fault not in ("blank", "duplicate"):
            for edits, added, moves in ((b"K", late, _KEEP.get(initial, ())), (b"R", REROLE + late, _TURNS)):
                for state, following in moves:
                    if state in self.alive:
                        self._offer(best, following, self.alive[state][0] + added, state, edits)
        self._settle(best)

    def end(self) -> tuple[int, str]:
        """(cost, all edits) of the best survivor in a state that may end a conversation."""
        best: dict[int, tuple[int, int, bytes]] = {}
        for state in (EMPTY, ASSISTANT):
            if state in self.alive:
                self._offer(best, EMPTY, self.alive[state][0], state, b"")
        cost, state, _ = best[EMPTY]
        return cost, (self.done + b"".join(reversed([n.edits for n in _up(self.alive[state][1])]))).decode()

    def _compare(self, a: tuple[int, bytes], b: tuple[int, bytes]) -> int | tuple[bytes, bytes]:
        """Two paths, each a survivor and edits after it: -1, 1, or what either has beyond the other."""
        (x, left), (y, right) = a, b
        if x != y:
            known = self.order[x, y]
            if isinstance(known, int):
                return known
            left, right = known[0] + left, known[1] + right
        if left.startswith(right) or right.startswith(left):
            return left[len(right):], right[len(left):]
        return -1 if left < right else 1

    def _offer(self, best: dict, state: int, cost: int, origin: int, edits: bytes) -> None:
        held = best.get(state)
        if held is None or cost < held[0] or (cost == held[0] and self._compare((origin, edits), held[1:]) == -1):
            best[state] = (cost, origin, edits)

    def _settle(self, best: dict[int, tuple[int, int, bytes]]) -> None:
        """Insertions after the row; then the tree takes the survivors' edits and gives up what is final."""
        for state, following in _TURNS:
            if state in best:
                cost, origin, edits = best[state]
                self._offer(best, following, cost + INSERT, origin, edits + b"I")
        for (state, other), added in _BRIDGE.items():
            if state in best and other in best and best[state][0] > best[other][0] + added:
                del best[state]
        paths = {state: path[1:] for state, path in best.items()}
        order = {(a, b): self._compare(paths[a], paths[b]) for a in paths for b in paths if a != b}
        alive: dict[int, tuple[int, Node]] = {}
        gone = []
        for origin, (_, node) in self.alive.items():
            heirs = [state for state in best if best[state][1] == origin]
            if not heirs:
                gone.append(node)
            elif len(heirs) == 1:
                node.edits += best[heirs[0]][2]
                alive[heirs[0]] = (best[heirs[0]][0], node)
            else:
                node.uses += len(heirs) - 1
                alive.update((state, (best[state][0], Node(node, best[state][2]))) for state in heirs)
        self.alive, self.order = alive, order
        for node in gone:
            self._release(node)
        self._emit()

    def _release(self, node: Node) -> None:
        """One use less; a node without any goes, and one with a single child becomes one with it."""
        node.uses -= 1
        while not node.uses and node.parent is not None:
            node = node.parent
            node.uses -= 1
        if node.uses == 1 and node is not self.root:
            child = self._child(node)
            if child is not None:
                node.edits += child.edits
                child.edits, child.parent = node.edits, node.parent

    def _child(self, node: Node) -> Node | None:
        """A node right below, None where only a survivor ends."""
        return next((n for _, leaf in self.alive.values() for n in _up(leaf) if n.parent is node), None)

    def _emit(self) -> None:
        """All survivors hang from the root, so its edits are final; and so on while there is one way."""
        while True:
            self.done += self.root.edits
            self.root.edits = bytearray()
            child = self._child(self.root) if self.root.uses == 1 else None
            if child is None:
                return
            child.parent, self.root = None, child


def _up(node: Node | None) -> Iterator[Node]:
    """A node and its ancestors."""
    while node is not None:
        yield node
        node = node.parent


class _Conversation:
    """Faults and edits of the rows of one conversation, in order."""

    def __init__(self) -> None:
        self.search = Search()
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal, self.last, self.turns, self.low, self.high, self.turn = 0, None, 0, None, None, None

    def row(self, turn: int | None, initial: str, fault: str) -> None:
        if turn is not None and turn != self.turn:
            self.turns += 1
            self.low, self.high, self.turn = turn if self.low is None else self.low, turn, turn
        if fault:
            self.counts[fault] += 1
        if self.last is not None and self.last + initial not in _SOUND_PAIRS:
            self.illegal += 1
        self.last = initial
        self.search.row(initial, fault)

    def values(self) -> tuple:
        gaps = min(_MOST, self.high - self.low + 1 - self.turns) if self.turns else 0
        return (gaps, *self.counts.values(), self.illegal, *self.search.end())


def _strings(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role and text as the search takes them, with a digest of the text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), text.alias("text"), F.unhex(F.sha2(text, 256)).alias("_digest"),
    )


def damage(rows: DataFrame) -> DataFrame:
    """The contract's faults, by a hash of conversation and turn; dropped rows are left out."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(key.cast("binary")) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    hurt = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("_kind")).where("_kind != 0")
    return hurt.select(
        "conv_id", "turn", F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    ).drop("_copy")


def plan(rows: DataFrame, all_ids: DataFrame | None = None) -> DataFrame:
    """conv_id, turn, role, text -> a row for each conversation: its faults, cost and edits (``audit``).

    ``all_ids`` (conv_id) adds conversations that have no rows.
    """
    session.prepare(rows.sparkSession)
    # Read back: the last character that is no white space ends its sentence or not.
    blank = ~F.regexp_like("text", F.lit(r"[^\x20\x09-\x0D]"))
    whole = F.regexp_like("text", F.lit(r"[.!?][\x20\x09-\x0D]*\z"))
    flag = F.when(blank, "blank").when(~whole, "truncated").otherwise("")
    narrow = _strings(rows).select("conv_id", "turn", "role", "_digest", flag.alias("_flag"), F.lit(1).alias("_kind"))
    if all_ids is not None:
        ids = all_ids.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
        narrow = narrow.unionByName(ids.withColumn("_kind", F.lit(0)), allowMissingColumns=True)
    order = [F.col("turn").asc_nulls_first(), "role", "_digest"]
    # The window groups within what the conversation's shuffle brought together. Of rows that are
    # equal in all, the one that counts as the first also comes first.
    seen = Window.partitionBy("conv_id", "role", "_digest").orderBy(F.col("turn").asc_nulls_first())
    told = narrow.repartition("conv_id").withColumn("_nth", F.row_number().over(seen))
    fault = F.when((F.col("_nth") > 1) & (F.col("_flag") != "blank"), "duplicate").otherwise(F.col("_flag"))
    ready = told.withColumn("fault", fault).withColumn("initial", F.substring("role", 1, 1))
    streamed = ready.sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "_kind", *order, "_nth")
    schema = "conv_id long, " + FIELDS
    names = [field.split()[0] for field in schema.split(", ")]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        current, conversation = None, None
        for batch in batches:
            for conv_id, turn, kind, fault, initial in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if conversation is None or conv_id != current:
                    if conversation:
                        out.append((current, *conversation.values()))
                    current, conversation = conv_id, _Conversation()
                if kind:
                    conversation.row(turn, initial, fault)
            if len(out) >= 1000:
                yield _batch(out, names)
                out = []
        if conversation:
            out.append((current, *conversation.values()))
        if out:
            yield _batch(out, names)

    return streamed.select("conv_id", "turn", "_kind", "fault", "initial").mapInArrow(search, schema)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = {"audit": pa.string(), "repaired_sha256": pa.string(), "role": pa.string(), "text": pa.string(), "edit": pa.string()}
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds.get(n, pa.int64())) for n, c in zip(names, columns, strict=True)], names=names)


def repaired(audit: str, rows: Iterable[tuple]) -> Iterator[tuple]:
    """(edit, role, text, turn) of every turn of the repaired conversation, one by one."""
    rows, state = iter(rows), EMPTY
    for edit in audit:
        turn, role, text = (None, None, "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        if edit == "K" and role.startswith("s"):
            state = SYSTEM
        else:
            state = ASSISTANT if state == USER else USER
        yield edit, role if edit == "K" else ROLES[state], text, turn


def apply(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """Rows and their plans -> conv_id, place, edit, role, text, turn of the repaired conversations.

    Within a partition a conversation's turns follow each other in order; an end mark (place
    null) closes each conversation, also one that lost all its turns.
    """
    session.prepare(rows.sparkSession)
    texts = _strings(rows).withColumns({"_kind": F.lit(1), "audit": F.lit(None).cast("string")})
    both = texts.unionByName(plans.select("conv_id", "audit", F.lit(0).alias("_kind")), allowMissingColumns=True)
    order = [F.col("conv_id").asc_nulls_first(), "_kind", F.col("turn").asc_nulls_first(), "role", "_digest"]
    streamed = both.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "turn", "role", "text", "audit")
    schema = "conv_id long, place long, edit string, role string, text string, turn long"
    names = [field.split()[0] for field in schema.split(", ")]

    def lay_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = _Peek(row for batch in batches for row in zip(*(column.to_pylist() for column in batch.columns), strict=True))
        out, held = [], 0
        while (head := stream.next()) is not None:
            conv_id, _, _, _, audit = head
            place = 0
            for edit, role, text, turn in repaired(audit, _rows_of(stream)):
                out.append((conv_id, place, edit, role, text, turn))
                place, held = place + 1, held + len(text)
                if held > 1 << 22 or len(out) >= 2000:
                    yield _batch(out, names)
                    out, held = [], 0
            out.append((conv_id, None, None, None, None, None))
        if out:
            yield _batch(out, names)

    return streamed.mapInArrow(lay_out, schema)


class _Peek:
    """An iterator that tells whether the next row is a conversation's plan."""

    def __init__(self, rows: Iterator[tuple]):
        self.rows, self.held = rows, None

    def next(self) -> tuple | None:
        row, self.held = self.held, None
        return row if row is not None else next(self.rows, None)

    def next_row(self) -> tuple | None:
        self.held = self.next()
        if self.held is None or self.held[4] is not None:
            return None
        row, self.held = self.held, None
        return row


def _rows_of(stream: _Peek) -> Iterator[tuple]:
    while (row := stream.next_row()) is not None:
        yield row[1:4]


def digests(turns: DataFrame) -> DataFrame:
    """What ``apply`` gives -> conv_id, repaired_sha256: one running hash, rows in their order."""
    schema = "conv_id long, repaired_sha256 string"

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        running = hashlib.sha256()
        for batch in batches:
            out = []
            for conv_id, place, role, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if place is None:
                    out.append((conv_id, running.hexdigest()))
                    running = hashlib.sha256()
                else:
                    running.update(f"{chr(10) if place else ''}{role}:{text}".encode())
            if out:
                yield _batch(out, ["conv_id", "repaired_sha256"])

    return turns.select("conv_id", "place", "role", "text").mapInArrow(add_up, schema)


def repair(rows: DataFrame) -> DataFrame:
    """Repaired conversations, a row for each turn: conv_id, place, edit, role, text, turn."""
    return apply(rows, plan(rows)).where(F.col("place").isNotNull())


def audited(rows: DataFrame, hurt: DataFrame) -> DataFrame:
    """For every conversation of ``rows``: what ``plan`` finds in ``hurt``, and its repaired digest."""
    plans = common.WorkTable(plan(hurt, rows.select("conv_id")), "plans").df
    found = digests(apply(hurt, plans))
    return plans.join(found, plans.conv_id.eqNullSafe(found.conv_id)).drop(found.conv_id)


