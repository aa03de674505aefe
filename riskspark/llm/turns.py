"""Conversation structure repair by Wagner-Fischer alignment with target strings.

The turns of a conversation are to become an optional system turn and then user
and assistant turns in alternation, or nothing at all.  For every length such a
string can have, the turns are aligned with it: a turn is kept, given the other
role or deleted, and empty turns are inserted.  All lengths that end alike share
one alignment table, filled from the end; Ukkonen's bound keeps only the
diagonals that a repair as cheap as the incumbent (keep every turn, insert
whatever is missing before it) can reach.  The audits of the cheapest lengths
are traced back, smallest letter first, and compared.

A conversation may be of any length.  Its turns are cut into blocks of bounded
size; for each block the alignments give the cost from every state of the
grammar to every other (16 numbers).  Read from the end, they give what is still
to pay after each block; read from the start with that, each block traces its
part of the one best audit.  Only that last step goes through a conversation in
order, and holds one block of it at a time.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import ready_workers, sorted_groups, written

#: States of the grammar: nothing yet, after a system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Fixed values of the contract: what a given role, a deletion, an insertion and a truncated turn that stays cost.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: What the end of a conversation costs in each state: the insertions that complete the last pair.
ENDING = (0, 2 * INSERT, INSERT, 0)
LETTERS = {USER: "u", ASSISTANT: "a"}
STATES = {"u": USER, "a": ASSISTANT, "s": SYSTEM}
NAMES = {"u": "user", "a": "assistant"}
#: No way leads on.
NONE = 1 << 60


def wanted(state: int) -> str:
    """The role that may follow a state, besides a system turn at the start."""
    return "a" if state == USER else "u"


def incumbent(rows: list[tuple[str, int]], state: int, end: int) -> int | None:
    """Cost of a plain repair from one state to another that keeps every u or a turn, inserting before it where the grammar asks; None if there is none."""
    cost = 0
    for role, cut in rows:
        cost += TRUNCATED * cut
        if role not in ("u", "a"):
            cost += REROLE
            role = wanted(state)
        elif role != wanted(state):
            cost += INSERT
        state = STATES[role]
    if not rows:
        return 0 if state == end else None
    # the wrong last role is mended by one more insertion before the last turn and giving it the other role
    return cost if state == end else cost + INSERT + REROLE


class Table:
    """Costs of aligning the rows from each one on with the last r letters of a string that ends in ``end``.

    ``rows`` are (role initial, truncated); no turn is inserted after the last.
    Cells on diagonals that cost more than ``slack`` to leave are not filled.
    """

    def __init__(self, rows: list[tuple[str, int]], end: int, slack: int):
        self.rows, self.end = rows, end
        n = len(rows)
        # a diagonal k letters longer costs k insertions, one k shorter as many deletions (of turns that may be truncated)
        longer, shorter = slack // INSERT, slack // (DELETE - TRUNCATED)
        last = LETTERS[end]
        other = "a" if last == "u" else "u"
        self.low = [max(0, n - i - shorter) for i in range(n + 1)]
        below = [0]
        self.cost = [None] * n + [below]
        for i in range(n - 1, -1, -1):
            role, cut = rows[i]
            low, high = self.low[i], n - i + longer
            under = self.low[i + 1]
            line: list[float] = []
            before = math.inf
            for r in range(low, high + 1):
                at = r - under
                # deletion, then the turn as the letter r from the end, then an insertion
                best = below[at] + DELETE if 0 <= at < len(below) else math.inf
                if r and 0 <= at - 1 < len(below):
                    letter = last if r & 1 else other
                    best = min(best, below[at - 1] + TRUNCATED * cut + (0 if role == letter else REROLE))
                if before + INSERT < best:
                    best = before + INSERT
                line.append(best)
                before = best
            self.cost[i] = below = line

    def of(self, i: int, r: int) -> float:
        at = r - self.low[i]
        return self.cost[i][at] if 0 <= at < len(self.cost[i]) else math.inf

    def letter(self, r: int) -> str:
        last = LETTERS[self.end]
        return last if r & 1 else ("a" if last == "u" else "u")

    def lengths(self, i: int, state: int) -> Iterator[tuple[int, float]]:
        """(length, cost) of the strings that may follow ``state``, for the rows from i on."""
        for at, cost in enumerate(self.cost[i]):
            r = at + self.low[i]
            if cost < math.inf and (self.letter(r) == wanted(state) if r else state == self.end):
                yield r, cost

    def trace(self, i: int, r: int) -> str:
        """The smallest of the cheapest audits of the rows from i on against the last r letters."""
        out = []
        while i < len(self.rows):
            role, cut = self.rows[i]
            cost = self.of(i, r)
            if self.of(i + 1, r) + DELETE == cost:
                out.append("D")
                i += 1
                continue
            if r and self.of(i, r - 1) + INSERT == cost:
                out.append("I")
            elif role == self.letter(r) and self.of(i + 1, r - 1) + TRUNCATED * cut == cost:
                out.append("K")
                i += 1
            else:
                out.append("R")
                i += 1
            r -= 1
        return "".join(out)


class Alignment:
    """Alignments of one block of turns, forced deletions left out."""

    def __init__(self, rows: list[tuple[str, int]]):
        self.rows = rows
        paid = TRUNCATED * sum(cut for _, cut in rows)
        self.tables = {}
        for end in (USER, ASSISTANT):
            bounds = [c - paid for c in (incumbent(rows, s, end) for s in range(4)) if c is not None]
            self.tables[end] = Table(rows, end, max(bounds, default=0))

    def options(self, state: int, end: int) -> Iterator[tuple[int, int, int, int]]:
        """(cost, rows deleted before a kept system turn or -1, place, length) of each way from one state to another."""
        rows, n = self.rows, len(self.rows)
        systems = [(i, cut) for i, (role, cut) in enumerate(rows) if role == "s"] if state == START else []
        if end == START:
            if state == START:
                yield DELETE * n, -1, n, 0
        elif end == SYSTEM:
            if state == SYSTEM:
                yield DELETE * n, -1, n, 0
            for i, cut in systems:
                yield DELETE * (n - 1) + TRUNCATED * cut, i, n, 0
        else:
            table = self.tables[end]
            for r, cost in table.lengths(0, state):
                yield cost, -1, 0, r
            for i, cut in systems:
                for r, cost in table.lengths(i + 1, SYSTEM):
                    yield DELETE * i + TRUNCATED * cut + cost, i, i + 1, r

    def costs(self) -> list[int]:
        """Cost from each state to each other, row by row; -1 where there is no way."""
        return [min((o[0] for o in self.options(s, e)), default=-1) for s in range(4) for e in range(4)]

    def best(self, state: int, after: list[int]) -> tuple[str, int]:
        """The audit from ``state`` that is the smallest of the cheapest, and the state it ends in; ``after`` is what each state still has to pay."""
        ways = [(cost + after[end], end, kept, at, r) for end in range(4) for cost, kept, at, r in self.options(state, end)]
        least = min(w[0] for w in ways)
        audits = []
        for cost, end, kept, at, r in ways:
            if cost == least:
                head = "D" * kept + "K" if kept >= 0 else ""
                rest = self.tables[end].trace(at, r) if end in self.tables else "D" * (len(self.rows) - len(head))
                audits.append((head + rest, end))
        return min(audits)


def with_deletions(audit: str, forced: list[bool]) -> str:
    """The audit with the deletions of the turns that have to go, each as early as it can be."""
    out, at = [], 0
    for letter in audit:
        while letter == "I" and at < len(forced) and forced[at] or letter != "I" and forced[at]:
            out.append("D")
            at += 1
        out.append(letter)
        at += letter != "I"
    out += "D" * (len(forced) - at)
    return "".join(out)


class Walk:
    """One conversation, turn by turn, block by block, in order."""

    def __init__(self):
        self.state, self.cost, self.audit, self.digest, self.said = START, 0, [], hashlib.sha256(), False
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.initial = self.low = self.high = None

    def say(self, role: str, text: str) -> None:
        self.digest.update((f"\n{role}:{text}" if self.said else f"{role}:{text}").encode())
        self.said = True

    def block(self, rows: list[dict], after: list[int]) -> None:
        core, forced = [], []
        for r in rows:
            first = r["new"] and not r["blank"]
            forced += [not first] + [True] * (r["times"] - 1)
            if first:
                core.append(r)
            if r["blank"]:
                self.blank += r["times"]
            else:
                self.duplicate += r["times"] - first
                self.truncated += first and r["cut"]
            if self.initial is not None:
                self.illegal += self.initial + r["initial"] not in ("su", "ua", "au")
            self.illegal += r["times"] - 1
            self.initial = r["initial"]
            if r["turn"] is not None:
                self.low = r["turn"] if self.low is None else self.low
                self.turns += self.high != r["turn"]
                self.high = r["turn"]
        audit, end = Alignment([(r["initial"], r["cut"]) for r in core]).best(self.state, after)
        turns = iter(core)
        for letter in audit:
            row = next(turns) if letter != "I" else None
            if letter == "D":
                self.cost += DELETE
                continue
            role = row["initial"] if letter == "K" else wanted(self.state)
            self.cost += INSERT if letter == "I" else TRUNCATED * row["cut"] + (REROLE if letter == "R" else 0)
            self.say(row["role"] if letter == "K" else NAMES[role], row["text"] if row else "")
            self.state = STATES[role]
        assert self.state == end
        self.cost += DELETE * sum(forced)
        self.audit.append(with_deletions(audit, forced))

    def end(self) -> tuple:
        while ENDING[self.state]:
            role = wanted(self.state)
            self.audit.append("I")
            self.cost += INSERT
            self.say(NAMES[role], "")
            self.state = STATES[role]
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest()


def damaged(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, times) of the contract's damage to conversations: what becomes of each row, and how often it is there (0: not at all)."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.pmod(F.crc32(key.cast("binary")), F.lit(20))
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), kind.alias("kind"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).alias("times"))


RESULT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def repair(turns: DataFrame, block_rows: int = 128) -> DataFrame:
    """One row per conversation of ``turns`` (conv_id, turn, role, text, times): its faults, and its cheapest repair.

    Columns: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256.  A conversation is the rows of one conv_id, a null one too,
    in the order of turn (nulls first), role and text; a row stands ``times``
    times, adjacently, a row of 0 times only names its conversation.  A null
    role or text is one space, a null ``times`` is 0.  Rows that repeat are
    duplicates.  A conversation without a turn has zeros, an empty audit and the
    hash of an empty string; an empty table gives no rows.

    Faults, the first of a row counts: blank has no character but white space,
    duplicate repeats role and text of an earlier row, truncated does not end in
    ``.!?`` before white space.  ``illegal`` counts neighbours whose role
    initials are not su, ua or au, ``gaps`` the turn numbers missing between the
    first and the last.  ``audit`` is the smallest of the cheapest repairs, one
    letter a step: D(elete), I(nsert), K(eep), R(erole).
    """
    if block_rows < 1:
        raise ValueError("a block has a row")
    ready_workers(turns.sparkSession)
    # conversations are told apart by a string that is there for a null id too
    rows = turns.select("conv_id", F.to_json(F.struct(F.col("conv_id").alias("c"))).alias("conv"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), F.col("times").cast("long").alias("times"))
    convs = rows.select("conv_id", "conv").distinct()
    # equal rows are one row with their number
    rows = rows.where("times > 0").groupBy("conv", "turn", "role", "text").agg(F.sum("times").alias("times"))
    rows = written(rows.withColumn("said", F.sha2(F.concat_ws("\x00", F.length("role").cast("string"), "role", "text").cast("binary"), 256)))
    first = rows.groupBy("conv", "said").agg(F.min(F.struct("turn")).alias("first"))
    solid = F.rtrim("text", F.lit(" \t\n\x0b\x0c\r"))
    rows = rows.join(first, ["conv", "said"]).select(
        "conv", "turn", "role", "text", "times", (F.struct("turn") == F.col("first")).alias("new"),
        (solid == "").alias("blank"), (~F.substring(solid, -1, 1).isin(".", "!", "?")).alias("cut"), F.substring("role", 1, 1).alias("initial"))
    # ranges of the order: a long conversation lies in many partitions; a row's place numbers partitions and rows in order
    order = ["conv", "turn", "role", "text"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    rows = written(rows.withColumn("block", F.floor(F.col("place") / block_rows).cast("long")))

    def blocks(batches):
        for g in sorted_groups(batches, ["conv", "block"]):
            costs = Alignment(list(zip(g["initial"].tolist(), g["cut"].tolist()))).costs()
            yield pa.RecordBatch.from_arrays([pa.array([g["conv"][0]]), pa.array([g["block"][0]]), pa.array([costs], pa.list_(pa.int64()))], names=["conv", "block", "costs"])

    stay = F.col("new") & ~F.col("blank")
    narrow = rows.where(stay).select("conv", "block", "place", "cut", "initial").repartition("conv", "block").sortWithinPartitions("conv", "block", "place")
    costs = narrow.mapInArrow(blocks, "conv string, block long, costs array<long>")

    def to_pay(batches):
        now, after = None, list(ENDING)
        for b in batches:
            names, numbers, costs = (b.column(c).to_pylist() for c in ("conv", "block", "costs"))
            out = []
            for conv, own in zip(names, costs):
                if conv != now:
                    now, after = conv, list(ENDING)
                out.append(after)
                after = [min((own[4 * s + e] + after[e] for e in range(4) if own[4 * s + e] >= 0), default=NONE) for s in range(4)]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(numbers, pa.int64()), pa.array(out, pa.list_(pa.int64()))], names=["conv", "block", "after"])

    # from the end: what is still to pay after each block
    after = costs.repartition("conv").sortWithinPartitions("conv", F.desc("block")).mapInArrow(to_pay, "conv string, block long, after array<long>")
    full = rows.select("conv", "block", "place", "turn", "role", F.when(stay, F.col("text")).alias("text"), "times", "new", "blank", "cut", "initial")
    full = full.join(after, ["conv", "block"], "left").repartition("conv").sortWithinPartitions("conv", "place")

    def walk(batches):
        now, one, held, block, after = None, None, [], None, None
        done: list[tuple] = []

        def sent():
            cols = list(zip(*done, strict=True))
            done.clear()
            kinds = [pa.string(), *[pa.int64()] * 6, pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["conv", *RESULT])

        def closed():
            if held:
                # a block of deletions only has nothing to choose
                one.block(held, after or [0] * 4)
                held.clear()

        for b in batches:
            for r in b.to_pylist():
                if r["conv"] != now or r["block"] != block:
                    closed()
                    if r["conv"] != now:
                        if one is not None:
                            done.append((now, *one.end()))
                            if len(done) >= 256:
                                yield sent()
                        now, one = r["conv"], Walk()
                    block, after = r["block"], r["after"]
                held.append(r)
        closed()
        if one is not None:
            done.append((now, *one.end()))
            yield sent()

    fields = ", ".join(f"{c} {'string' if c in ('audit', 'repaired_sha256') else 'long'}" for c in RESULT)
    found = full.mapInArrow(walk, f"conv string, {fields}")
    nothing = {"audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256().hexdigest())}
    return convs.join(found, "conv", "left").select("conv_id", *[F.coalesce(c, nothing.get(c, F.lit(0).cast("long"))).alias(c) for c in RESULT])
