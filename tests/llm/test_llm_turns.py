"""Conversation repair against a search over whole edit scripts, over the automaton, and over blocks of any size."""

from __future__ import annotations

import hashlib
import random
import zlib
from itertools import groupby

from pyspark.sql import functions as F

from riskspark.llm.turns import Alignment, damaged, repair

SCHEMA = "conv_id long, turn long, role string, text string, times long"
SPACE = " \t\n\x0b\x0c\r"


def by_hand(rows):
    """rows: (conv_id, turn, role, text, times); the cheapest audit by a table over rows and grammar states that keeps the best (cost, audit) of each."""
    out = {r[0]: (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()) for r in rows}
    key = lambda r: (r[0] is not None, r[0] or 0)
    live = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x, n in rows for _ in range(n or 0)]
    for _, own in groupby(sorted(live, key=key), key):
        own = sorted(own, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        faults, seen = [], set()
        for _, _, role, text in own:
            solid = text.rstrip(SPACE)
            faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
            seen.add((role, text))
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        best = {0: (0, "", [])}
        for (_, _, role, text), fault in zip(own, faults):
            new = {}

            def offer(state, cost, audit, said):
                if state not in new or (cost, audit) < new[state][:2]:
                    new[state] = (cost, audit, said)

            for state, (cost, audit, said) in best.items():
                offer(state, cost + 3, audit + "D", said)
                if fault in ("blank", "duplicate"):
                    continue
                cost += fault == "truncated"
                if state == 0 and role[:1] == "s":
                    offer(1, cost, audit + "K", [*said, f"{role}:{text}"])
                for inserted in range(4):
                    letter = ("ua" if state != 2 else "au") * 3
                    now = letter[inserted]
                    fill = [f"{'user' if x == 'u' else 'assistant'}:" for x in letter[:inserted]]
                    if role[:1] == now:
                        offer(2 if now == "u" else 3, cost + 2 * inserted, audit + "I" * inserted + "K", [*said, *fill, f"{role}:{text}"])
                    offer(2 if now == "u" else 3, cost + 2 * inserted + 2, audit + "I" * inserted + "R", [*said, *fill, f"{'user' if now == 'u' else 'assistant'}:{text}"])
            best = new
        ends = [(c + 2 * n, a + "I" * n, s + fill) for state, (c, a, s) in best.items()
                for n, fill in [{0: (0, []), 1: (2, ["user:", "assistant:"]), 2: (1, ["assistant:"]), 3: (0, [])}[state]]]
        cost, audit, said = min(ends)
        out[own[0][0]] = (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest())
    return out


def found(spark, rows, **kw):
    got = repair(spark.createDataFrame(rows, SCHEMA), **kw).collect()
    assert len(got) == len({r[0] for r in rows})
    return {r[0]: tuple(r)[1:] for r in got}


def conversations(n, longest, seed):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randrange(0, longest) + 1):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "unit"])
            text = rng.choice([f"t{t}.", f"t{t}.", f"t{t}!", f"x{t}", "", " \n", None, "same?", "same", "é. \t", "a "])
            rows.append((c, rng.choice([t, t, t, t, None, t * 2, 0]), role, text, rng.choice([1, 1, 1, 1, 2, 0, 3])))
    return rows


def test_against_the_search(spark):
    rows = conversations(150, 7, 1)
    assert found(spark, rows) == by_hand(rows)


def test_long_conversations_in_blocks_of_any_size(spark):
    rows = conversations(6, 60, 2) + [(77, t, random.Random(t).choice(["user", "assistant"]), f"{t}.", 1) for t in range(300)]
    want = by_hand(rows)
    for size in (1, 3, 16, 1000):
        assert found(spark, rows, block_rows=size) == want


def test_bounds_lose_no_alignment():
    rng = random.Random(3)
    for _ in range(300):
        rows = [(rng.choice("uuaas t"), rng.random() < 0.3) for _ in range(rng.randrange(0, 9))]
        one = Alignment(rows)
        for state in range(4):
            after = [rng.randrange(0, 7) for _ in range(4)]
            best = one.best(state, after)
            # all scripts without insertions after the last row
            ways = [(0, "", state)]
            for role, cut in rows:
                new = []
                for cost, audit, s in ways:
                    new.append((cost + 3, audit + "D", s))
                    if s == 0 and role == "s":
                        new.append((cost + cut, audit + "K", 1))
                    for k in range(3):
                        now = "ua"[(k + (s == 2)) % 2]
                        end = 2 if now == "u" else 3
                        new.append((cost + 2 * k + cut + (0 if role == now else 2), audit + "I" * k + ("K" if role == now else "R"), end))
                keep = {}
                for w in sorted(new):
                    keep.setdefault(w[2], w)
                ways = list(keep.values())
            least = min((c + after[e], a, e) for c, a, e in ways)
            assert (best[0], best[1]) == least[1:]


def test_damage_of_the_contract(spark):
    rows = [(c, t, r, x) for c in range(40) for t in [*range(8), None] for r, x in [("user" if c % 2 else None, f"Hi {t}. Ok!")]] + [(None, 3, "system", None)]
    got = sorted(map(tuple, damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()), key=repr)
    want = []
    for c, t, r, x in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        x = "" if kind == 1 else "".join(ch for ch in x if ch not in ".!?") if kind == 2 else x
        want.append((c, t, "user" if kind == 4 else r, x, 0 if kind == 0 else 2 if kind == 3 else 1))
    assert got == sorted(want, key=repr)


def test_nothing_left_null_ids_long_texts_and_clashing_names(spark):
    rows = [(1, 0, "user", "x.", 0), (None, 0, "user", "q?", 1), (None, None, "assistant", "z." * 200000, 1), (2, None, None, None, 1), (2, None, None, None, 1), (3, 5, "user", "a.", 70), (4, 1, "user", "b.", None)]
    assert found(spark, rows) == by_hand(rows)
    assert found(spark, []) == {}
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("conv", "block", "place", "said", "first", "after", "costs", "cut", "new", "blank", "initial", "audit"):
        df = df.withColumn(c, F.lit("x"))
    assert {r[0]: tuple(r)[1:] for r in repair(df).collect()} == by_hand(rows)
