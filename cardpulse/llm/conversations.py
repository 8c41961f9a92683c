"""Conversation structure repair by Knuth's lightest derivation.

A conversation is sound if its role initials read ``(s?(ua)+)?``: nothing, or
an optional system turn and then pairs of user and assistant.  Cheapest edits
make it sound: Keep (0), Rerole to user or assistant (2), Delete (3; blank and
duplicate rows have to go), Insert an empty user or assistant turn (2); a
truncated row that stays costs 1 more.  Ties go to the ASCII-least audit, the
initials of the edits in order.

*The deduction system.*  Items are (row, state): the cheapest way to go on from
that row in that state of the pattern.  Every edit is a hyperedge that derives
an item from a later one, and its function adds the edit's cost and puts the
edit's initial before the audit.  An agenda pops the least open item; functions
are superior in the order (cost, rows covered, audit), since an edit that is
free covers one row more, so a popped item is final, and the search ends when
its goal item pops.

*Long conversations.*  Rows are ordered by range partitioning over the whole
sort key and cut into chunks of ``CHUNK``; the agenda runs per chunk and exit
state and gives a table state -> state -> (cost, audit).  Tables are combined in
order, so no task holds a conversation: a stream over its chunks carries the
best audits of the four states, hands on what they have in common and feeds the
kept texts to the running digest.  Two audits of equal cost over the same rows
never are one the other's beginning (the longer one would hold more paid
inserts), so the least of parts is the least of the whole.

Equal rows are counted before they are ordered: the second and later ones are
duplicates, a run of deletions.  The result row of a conversation holds its
whole audit, and its digest is sequential by nature.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardpulse.llm.common import arrow_map, staged

#: A chunk ends after so many different rows or code points.
CHUNK, CHUNK_LENGTH = 128, 1 << 16
#: Code points of role and text that deal rows to partitions; rows alike in these stay together and are sorted whole.
PREFIX = 64
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
ROLES = {"u": "user", "a": "assistant"}
#: States of ``(s?(ua)+)?`` and what may follow: role initial -> next state.
START, SYSTEM, USER, ASSISTANT = range(4)
MOVES = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
ACCEPTING = (START, ASSISTANT)
LEGAL = frozenset(("su", "ua", "au"))
VISIBLE = "[^\\x20\\x09-\\x0D]"

#: One row of a conversation in an agenda: (role initial, must go, truncated, equal rows that follow and go).
Row = tuple[str, bool, bool, int]


def lightest(rows: list[Row], exits: tuple[int, ...], entries: tuple[int, ...] = (START, SYSTEM, USER, ASSISTANT)) -> dict[int, tuple[int, str]]:
    """Per entry state the least (cost, audit) of a way through ``rows`` that ends in one of ``exits``.

    The agenda works from the last row to the first and stops once every
    entry item is popped.
    """
    n = len(rows)
    into = [[(state, letter) for state in range(4) for letter, to in MOVES[state].items() if to == target] for target in range(4)]
    final: set[tuple[int, int]] = set()
    agenda = [(0, 0, "", state) for state in exits]
    heapq.heapify(agenda)
    goals, found = set(entries), {}
    while agenda and goals:
        cost, covered, audit, state = heapq.heappop(agenda)
        if (covered, state) in final:
            continue
        final.add((covered, state))
        if covered == n and state in goals:
            goals.remove(state)
            found[state] = (cost, audit)
        for before, letter in into[state]:
            if letter in ROLES and (covered, before) not in final:
                heapq.heappush(agenda, (cost + INSERT, covered, "I" + audit, before))
        if covered == n:
            continue
        letter_here, must_go, truncated, more = rows[n - 1 - covered]
        rest = "D" * more + audit
        cost += DELETE * more
        heapq.heappush(agenda, (cost + DELETE, covered + 1, "D" + rest, state))
        if not must_go:
            for before, letter in into[state]:
                if letter == letter_here:
                    heapq.heappush(agenda, (cost + KEEP + TRUNCATED * truncated, covered + 1, "K" + rest, before))
                if letter in ROLES:
                    heapq.heappush(agenda, (cost + REROLE + TRUNCATED * truncated, covered + 1, "R" + rest, before))
    return found


def applied(audit: str, rows: list[tuple[str, str, int]], state: int) -> tuple[list[str], int]:
    """The repaired ``role:text`` turns of (role, text, count) rows under ``audit``, and the state reached."""
    expanded = (row for row in rows for _ in range(row[2]))
    out = []
    for edit in audit:
        role, text = next(expanded)[:2] if edit != "I" else (None, "")
        if edit == "D":
            continue
        if edit == "K":
            state = MOVES[state][role[:1]]
        else:
            letter = "a" if state == USER else "u"
            role, state = ROLES[letter], MOVES[state][letter]
        out.append(f"{role}:{text}")
    return out, state


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, n): rows after the fixed damage, equal rows counted.

    crc32 of ``conv_id:turn`` mod 20 decides: 0 drops the row, 1 empties its
    text, 2 removes its ``[.!?]``, 3 repeats it, 4 makes its role user.
    A null is one space, in the name too; a null turn stays null in order.
    """
    blank = F.lit(" ")
    name = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), blank), F.coalesce(F.col("turn").cast("string"), blank))
    hit = F.crc32(name.cast("binary")) % 20
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                F.coalesce(F.col("role").cast("string"), blank).alias("role"), F.coalesce(F.col("text").cast("string"), blank).alias("text"), hit.alias("hit"))
    rows = rows.where("hit <> 0").select(
        "conv_id", "turn", F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("hit") == 3, 2).otherwise(1).alias("n"))
    return rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n"))


def _seen_earlier(rows: DataFrame) -> DataFrame:
    """``rows`` with ``seen``: an earlier row of the conversation has this role and text.

    First uses come from an aggregate that is partial before its shuffle and
    are joined on the whole row, so no text repeated in a conversation is a hot key.
    """
    order = F.struct(F.col("turn").isNotNull().alias("has"), F.col("turn").alias("at"))
    first = rows.groupBy("conv_id", "role", "text").agg(F.min(order).alias("first"))
    first = first.select(F.col("conv_id").alias("f_conv"), F.col("role").alias("f_role"), F.col("text").alias("f_text"), F.col("first.at").alias("f_turn"))
    same = (F.col("conv_id").eqNullSafe(F.col("f_conv")) & F.col("turn").eqNullSafe(F.col("f_turn")) & (F.col("role") == F.col("f_role")) & (F.col("text") == F.col("f_text")))
    return rows.join(first, same, "left").select(*rows.columns, F.col("f_role").isNull().alias("seen"))


def _ends_well(text: Column) -> Column:
    return F.btrim(text, F.lit(" \t\n\x0b\x0c\r")).rlike("[.!?]\\z")


CHUNK_SCHEMA = ("conv_id long, part int, at long, blank long, duplicate long, truncated long, illegal long, first string, last string, "
                "turns long, turn_min long, turn_max long, costs array<long>, audits array<string>, roles array<string>, texts array<string>, counts array<long>")


def _chunks(rows: DataFrame) -> DataFrame:
    """Rows in order, cut into chunks that carry their tables of cheapest ways."""
    by_turn = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first()]
    is_blank = ~F.col("text").rlike(VISIBLE)
    flagged = rows.select("conv_id", "turn", "role", "text", "n", "seen", is_blank.alias("blank"), (~is_blank & ~_ends_well(F.col("text"))).alias("ends_badly"))
    dealt = flagged.repartitionByRange(*by_turn, F.left("role", F.lit(PREFIX)).asc(), F.left("text", F.lit(PREFIX)).asc())
    ordered = dealt.sortWithinPartitions(*by_turn, F.col("role").asc(), F.col("text").asc())
    names = [f.split()[0] for f in CHUNK_SCHEMA.split(", ")]

    def summary(conv_id, at, own):
        turns = [t for t, *_ in own if t is not None]
        part = TaskContext.get().partitionId()
        faults, agenda = [0, 0, 0], []
        pairs, last = 0, None
        for _, role, _, n, seen, blank, ends_badly in own:
            if blank:
                faults[0] += n
            elif seen:
                faults[1] += n
            else:
                faults[1] += n - 1
                faults[2] += ends_badly
            c = role[:1]
            pairs += (last is not None and last + c not in LEGAL) + (n - 1 if n > 1 and c + c not in LEGAL else 0)
            last = c
            agenda.append((c, blank or seen, not blank and not seen and ends_badly, n - 1))
        ways = [lightest(agenda, (exit_,)) for exit_ in range(4)]
        table = [ways[j].get(i, (-1, "")) for i in range(4) for j in range(4)]
        return [conv_id, part, at, *faults, pairs, own[0][1][:1], last, len(set(turns)), min(turns, default=None), max(turns, default=None),
                [c for c, _ in table], [a for _, a in table], [r for _, r, *_ in own], ["" if s or b else t for _, _, t, _, s, b, _ in own], [n for _, _, _, n, *_ in own]]

    def run(batches: Iterator[pa.RecordBatch]):
        types = [pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.string(), pa.string(), *[pa.int64()] * 3,
                 pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.string()), pa.list_(pa.string()), pa.list_(pa.int64())]
        own, here, at, length = [], None, 0, 0

        def batch(out):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

        for b in batches:
            out = []
            for conv_id, *row in zip(*(c.to_pylist() for c in b.columns)):
                if own and (conv_id != here or len(own) == CHUNK or length >= CHUNK_LENGTH):
                    out.append(summary(here, at, own))
                    own, at, length = [], at + 1, 0
                here = conv_id
                own.append(row)
                length += len(row[2])
            if out:
                yield batch(out)
        if own:
            yield batch([summary(here, at, own)])

    return arrow_map(ordered, run, CHUNK_SCHEMA)


RESULT_SCHEMA = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _common(texts: list[str]) -> int:
    lo, hi = min(texts), max(texts)
    return next((i for i, c in enumerate(lo) if c != hi[i]), len(lo))


class _Conversation:
    """Folds the chunks of one conversation in order."""

    def __init__(self) -> None:
        self.faults = [0, 0, 0, 0]
        self.last = None
        self.turns, self.low, self.high = 0, None, None
        self.ways = {START: (0, "")}  # state -> (cost, audit after what was handed on)
        self.done: list[str] = []
        self.waiting: list[tuple[str, str, int]] = []
        self.digest, self.state, self.some = hashlib.sha256(), START, False

    def add(self, chunk: dict) -> None:
        for i, name in enumerate(("blank", "duplicate", "truncated", "illegal")):
            self.faults[i] += chunk[name]
        if self.last is not None and self.last + chunk["first"] not in LEGAL:
            self.faults[3] += 1
        self.last = chunk["last"]
        if chunk["turns"]:
            self.turns += chunk["turns"] - (self.high == chunk["turn_min"])
            self.low = chunk["turn_min"] if self.low is None else self.low
            self.high = chunk["turn_max"]
        new: dict[int, tuple[int, str]] = {}
        for i, (cost, audit) in self.ways.items():
            for j in range(4):
                more = chunk["costs"][4 * i + j]
                if more >= 0:
                    way = (cost + more, audit + chunk["audits"][4 * i + j])
                    if j not in new or way < new[j]:
                        new[j] = way
        self.ways = new
        self.waiting.extend(zip(chunk["roles"], chunk["texts"], chunk["counts"]))
        self._hand_on(_common([a for _, a in new.values()]))

    def _hand_on(self, n: int) -> None:
        """The first ``n`` edits are the same in all ways: apply those that end with whole rows."""
        audit = next(iter(self.ways.values()))[1]
        rows = used = end = 0  # rows and edits up to the last whole row
        seen = 0
        for i in range(n):
            if audit[i] != "I":
                seen += 1
                if seen == self.waiting[rows][2]:
                    rows, seen, end = rows + 1, 0, i + 1
        turns, self.state = applied(audit[:end], self.waiting[:rows], self.state)
        for turn in turns:
            self.digest.update((("\n" if self.some else "") + turn).encode("utf-8", "surrogatepass"))
            self.some = True
        self.done.append(audit[:end])
        del self.waiting[:rows]
        self.ways = {s: (c, a[end:]) for s, (c, a) in self.ways.items()}

    def result(self) -> list:
        cost, audit = min(self.ways[s] for s in ACCEPTING if s in self.ways)
        self.ways = {START: (cost, audit)}
        turns, _ = applied(audit, self.waiting, self.state)
        for turn in turns:
            self.digest.update((("\n" if self.some else "") + turn).encode("utf-8", "surrogatepass"))
            self.some = True
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return [gaps, *self.faults, cost, "".join(self.done) + audit, self.digest.hexdigest()]


def repaired(rows: DataFrame) -> DataFrame:
    """``RESULT_SCHEMA`` per conversation of ``rows`` (conv_id, turn, role, text, n).

    Rows are taken by turn, nulls first; rows of one turn by role and text.
    A null conv_id is a conversation of its own.
    """
    chunks = staged(_chunks(_seen_earlier(rows)), "conversations")
    order = ["conv_id", "part", "at"]
    own = chunks.repartition("conv_id").sortWithinPartitions(*order)
    names = [f.split()[0] for f in RESULT_SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]):
        types = [*[pa.int64()] * 7, pa.string(), pa.string()]
        here, state = None, None

        def batch(out):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

        for b in batches:
            out = []
            # a few chunks at a time are Python objects
            for lo in range(0, b.num_rows, 64):
                for chunk in b.slice(lo, 64).to_pylist():
                    if state is not None and chunk["conv_id"] != here:
                        out.append([here, *state.result()])
                        state = None
                    if state is None:
                        here, state = chunk["conv_id"], _Conversation()
                    state.add(chunk)
            if out:
                yield batch(out)
        if state is not None:
            yield batch([[here, *state.result()]])

    return arrow_map(own, run, RESULT_SCHEMA)


def damaged_and_repaired(conversations: DataFrame) -> DataFrame:
    """``repaired`` over the damaged rows, with a row for every conv_id; one that lost all its rows has zeros, an empty audit and the digest of an empty text."""
    found = repaired(damaged(conversations))
    every = conversations.select(F.col("conv_id").cast("long").alias("own_id")).distinct()
    out = every.join(found, F.col("own_id").eqNullSafe(F.col("conv_id")), "left")
    numbers = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(F.col("own_id").alias("conv_id"), *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
