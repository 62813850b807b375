"""Conversation structure repair: the cheapest edits after which turns alternate.

A repaired conversation has the roles ``(s?(ua)+)?`` (initials: an optional system turn, then user
and assistant in turn) or is empty. Each row is kept (0), gets the role user or assistant (2) or is
deleted (3); empty user and assistant turns are inserted (2). Blank and repeated rows must go; a
truncated row that stays costs 1 more. Of the cheapest edits, those with the least initials win.

The edits are found by depth-first branch-and-bound: an explicit stack of partial repairs, a lower
bound for the rows still to come, the best whole repair so far (cost, audit), and a table for each
node (row, state of the pattern) of the best prefix that reached it; a prefix that is no better
than its node's is dropped, as what can follow is the same. The search ends when the stack is
empty, that is when nothing left could be better.

Rows come sorted to one task per conversation and are read as a stream. A conversation of more
than ``BLOCK_ROWS`` rows is searched block by block: for each state at a block's end the best
prefix survives (four at most, with a running digest each), and the next block starts from these.
So memory holds one block of rows and one character per row for the audit, however long a
conversation is; its digest is sequential by definition, so a conversation is one task's work.

Defined results: a null role or text is one space (whose initial is no role's); rows come by turn
(null first), then role, then text; rows of no ``conv_id`` are one conversation; the first fault of
blank, duplicate, truncated counts; a conversation without rows has zeros, an empty audit and the
digest of nothing. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 256
BLOCK_CHARS = 4 << 20
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"

# What an edit costs, by its initial, and what a truncated row adds where it stays.
COSTS = {"K": 0, "R": 2, "D": 3, "I": 2}
TRUNCATED_COST = 1
ROLES = {"u": "user", "a": "assistant"}

# States of the pattern: nothing yet, after the system turn, after a user's, after an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
DONE = (START, ASSISTANT)

FINE, MUST_GO, TRUNCATED = range(3)


@dataclass
class Prefix:
    """The best repair of all blocks so far that ends in one state."""

    cost: int
    rank: int  # place of its audit among the survivors'
    digest: object
    empty: bool  # nothing is in the repaired conversation yet
    before: Prefix | None = None
    audit: str = ""  # of the last block
    roles: str = ""


def search(initials: list[str], faults: list[int], entries: dict[int, tuple[int, int]], last: bool) -> dict[int, tuple[int, str, str, int]]:
    """The best way through a block: ``exit state -> (cost, audit, roles, entry state)``.

    ``entries``: cost and rank by state. In the last block turns may be inserted at the end, and
    only the best repair that fits the pattern is returned.
    """
    n = len(initials)
    bound = [0] * (n + 1)  # what the rows from i on cost at least
    for i in range(n - 1, -1, -1):
        bound[i] = bound[i + 1] + (COSTS["D"] if faults[i] == MUST_GO else TRUNCATED_COST if faults[i] == TRUNCATED else 0)
    best: dict[int, tuple[int, str, str, int]] = {}
    reached: dict[tuple[int, int], tuple[int, str]] = {}

    def limit() -> tuple[int, str] | None:
        """What a repair must be better than to matter at all."""
        if last:
            return min((b[:2] for b in best.values()), default=None)
        return max(b[:2] for b in best.values()) if len(best) == len(NEXT) else None

    def hopeless(i: int, cost: int, audit: str) -> bool:
        worst = limit()
        if worst is None or cost + bound[i] < worst[0]:
            return False
        return cost + bound[i] > worst[0] or audit > worst[1][: len(audit)]

    # the rank of the entry goes before the block's own edits, so ties between entries are settled by it
    stack = [(0, state, cost, chr(rank), "", state) for state, (cost, rank) in sorted(entries.items(), key=lambda e: e[1], reverse=True)]
    while stack:
        i, state, cost, audit, roles, entry = stack.pop()
        if hopeless(i, cost, audit):
            continue
        known = reached.get((i, state))
        if known is not None and known <= (cost, audit):
            continue
        reached[i, state] = (cost, audit)
        if i == n and (not last or state in DONE):
            held = best.get(state)
            if held is None or (cost, audit) < held[:2]:
                best[state] = (cost, audit, roles, entry)
        moves = []
        if i < n or last:
            moves += [(i, to, cost + COSTS["I"], audit + "I", roles + r, entry) for r, to in NEXT[state].items() if r in ROLES]
        if i < n:
            moves.append((i + 1, state, cost + COSTS["D"], audit + "D", roles + "-", entry))
            if faults[i] != MUST_GO:
                stays = cost + (TRUNCATED_COST if faults[i] == TRUNCATED else 0)
                for r, to in NEXT[state].items():
                    if r == initials[i]:
                        moves.append((i + 1, to, stays + COSTS["K"], audit + "K", roles + r, entry))
                    elif r in ROLES:
                        moves.append((i + 1, to, stays + COSTS["R"], audit + "R", roles + r, entry))
        # the most promising one is looked at first, so that a good repair is known early
        stack += sorted(moves, key=lambda m: (m[2] + bound[m[0]], m[0], m[3]), reverse=True)
    if last:
        state = min(best, key=lambda s: best[s][:2])
        best = {state: best[state]}
    return {state: (cost, audit[1:], roles, entry) for state, (cost, audit, roles, entry) in best.items()}


class Conversation:
    """One conversation's rows, taken in order."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.turns = 0
        self.first = self.last = None
        self.before = None  # the initial of the row before
        self.rows: list[tuple[str, str, str, int]] = []
        self.chars = 0
        self.prefixes = {START: Prefix(0, 0, hashlib.sha256(), True)}

    def take(self, turn: int | None, role: str, text: str, again: bool) -> None:
        stripped = text.rstrip(SPACES)
        if not stripped:
            fault = MUST_GO
            self.blank += 1
        elif again:
            fault = MUST_GO
            self.duplicate += 1
        elif stripped[-1] not in ".!?":
            fault = TRUNCATED
            self.truncated += 1
        else:
            fault = FINE
        if turn is not None and turn != self.last:
            self.turns += 1
            self.first = turn if self.first is None else self.first
            self.last = turn
        initial = role[:1] or " "
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        self.rows.append((initial, role, text, fault))
        self.chars += len(text)
        if len(self.rows) >= BLOCK_ROWS or self.chars >= BLOCK_CHARS:
            self.close(last=False)

    def close(self, last: bool) -> None:
        found = search([r[0] for r in self.rows], [r[3] for r in self.rows], {s: (p.cost, p.rank) for s, p in self.prefixes.items()}, last)
        order = sorted(found, key=lambda s: (self.prefixes[found[s][3]].rank, found[s][1]))
        after = {}
        for rank, state in enumerate(order):
            cost, audit, roles, entry = found[state]
            start = self.prefixes[entry]
            digest, empty = start.digest.copy(), start.empty
            rows = iter(self.rows)
            for edit, role in zip(audit, roles):
                row = None if edit == "I" else next(rows)
                if edit == "D":
                    continue
                name = row[1] if edit == "K" else ROLES[role]
                line = f"{name}:{row[2] if row else ''}"
                digest.update((line if empty else "\n" + line).encode("utf-8", "surrogatepass"))
                empty = False
            after[state] = Prefix(cost, rank, digest, empty, start, audit, roles)
        self.prefixes, self.rows, self.chars = after, [], 0

    def report(self) -> tuple:
        self.close(last=True)
        (end,) = self.prefixes.values()
        audits, roles, at = [], [], end
        while at is not None:
            audits.append(at.audit)
            roles.append(at.roles)
            at = at.before
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return (
            self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, end.cost,
            "".join(reversed(audits)), "".join(reversed(roles)), end.digest.hexdigest(),
        )


_REPORT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, roles string, repaired_sha256 string"
)
_ARROW_REPORT = pa.schema(
    [(n.split()[0], pa.int64() if n.split()[1] == "long" else pa.string()) for n in _REPORT.split(", ")]
)


def _filled(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" ")).alias(name)


def _in_order(conversations: DataFrame, gone: Column | None) -> DataFrame:
    """Rows of a conversation together and sorted, each with ``again``: role and text stood further up."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), _filled("role"), _filled("text"),
        (F.lit(False) if gone is None else F.coalesce(gone, F.lit(False))).alias("gone"),
    )
    same = Window.partitionBy("conv_id", "role", "text", "gone").orderBy(F.col("turn").asc_nulls_first())
    # rows dealt by conversation already lie together for the narrower window: one shuffle
    marked = rows.repartition("conv_id").withColumn("again", F.row_number().over(same) > 1)
    return marked.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text", "again")


def repair(conversations: DataFrame, gone: Column | None = None) -> DataFrame:
    """One row a conversation of ``conversations`` (conv_id, turn, role, text): its faults and its cheapest repair.

    ``audit`` has an initial for each edit in order, ``roles`` the initial of the role that comes of
    it (``-`` for a deleted row). Rows for which ``gone`` holds are not there, but their conversation is.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                for conv_id, turn, role, text, absent, again in zip(*(part.column(k).to_pylist() for k in range(6))):
                    if now is None or now.conv_id != conv_id:
                        if now is not None:
                            done.append(now.report())
                        now = Conversation(conv_id)
                    if not absent:
                        now.take(turn, role, text, again)
            if done:
                yield _batch(done)
                done = []
        if now is not None:
            yield _batch([now.report()])

    return _in_order(conversations, gone).mapInArrow(run, _REPORT)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), _ARROW_REPORT)], schema=_ARROW_REPORT)


def repaired_turns(conversations: DataFrame, reports: DataFrame, gone: Column | None = None) -> DataFrame:
    """The repaired conversations as rows ``conv_id, place, edit, role, text``; ``reports`` are those of ``repair``."""

    def edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for conv_id, audit, roles in zip(*(batch.column(k).to_pylist() for k in range(3))):
                source, place, rows = 0, 0, []
                for edit, role in zip(audit, roles):
                    source += edit != "I"
                    if edit != "D":
                        rows.append((conv_id, place, edit, None if edit == "K" else ROLES[role], None if edit == "I" else source))
                        place += 1
                    if len(rows) >= 10_000:
                        yield made(rows)
                        rows = []
                if rows:
                    yield made(rows)

    def made(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["conv_id", "place", "edit", "new_role", "source"])

    chosen = reports.select("conv_id", "audit", "roles").mapInArrow(edits, "conv_id long, place long, edit string, new_role string, source long")
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text", "again")
    rows = _in_order(conversations, gone).where("NOT gone").withColumn("source", F.row_number().over(order).cast("long"))
    left, right = chosen.alias("e"), rows.select("conv_id", "source", "role", "text").alias("r")
    return left.join(right, F.expr("e.conv_id <=> r.conv_id AND e.source = r.source"), "left").select(
        "e.conv_id", "e.place", "e.edit", F.coalesce("e.new_role", "r.role").alias("role"), F.coalesce("r.text", F.lit("")).alias("text")
    )
