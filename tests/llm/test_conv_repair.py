"""Conversation repair against a brute-force search over all edits; Hirschberg against the full table."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from regalign.llm import conv_repair as C

SCHEMA = "conv_id long, turn long, role string, text string"
BLANK = " \t\n\x0b\x0c\r"
EMPTY = hashlib.sha256(b"").hexdigest()


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if hit == 1:
            text = ""
        if hit == 2:
            text = "".join(c for c in text if c not in ".!?")
        if hit == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
    return out


def order(rows):
    def h(r):
        return hashlib.sha256(f"{len(r[2])}:{r[2]}:{r[3]}".encode()).hexdigest()

    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], h(r)))


def brute(rows):
    """Least (cost, audit) by a search over single edits, path strings and repaired lines carried along."""
    rows = order(rows)
    if not rows:
        return (0, 0, 0, 0, 0, 0, "", EMPTY)
    seen, faults, kinds = set(), [0, 0, 0], []
    for _, _, role, text in rows:
        body = text.strip(BLANK)
        fault = 0 if not body else 1 if (role, text) in seen else 2 if body[-1] not in ".!?" else None
        seen.add((role, text))
        kinds.append(fault)
        if fault is not None:
            faults[fault] += 1
    initials = [r[2][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    need = {"": "u", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user", "a": "assistant"}

    def inserted(best):
        for _ in range(3):
            for s, (cost, audit, lines) in list(best.items()):
                t = need[s]
                new = (cost + 2, audit + "I", lines + [name[t] + ":"])
                if t not in best or new < best[t]:
                    best[t] = new
        return best

    best = {"": (0, "", [])}
    for (_, _, role, text), fault in zip(rows, kinds):
        best, new = inserted(dict(best)), {}
        for s, (cost, audit, lines) in best.items():
            moves = [(s, 3, "D", [])]
            if fault not in (0, 1):
                late = 1 if fault == 2 else 0
                moves.append((need[s], 2 + late, "R", [f"{name[need[s]]}:{text}"]))
                if role[:1] == need[s] or (role[:1] == "s" and s == ""):
                    moves.append((role[:1], late, "K", [f"{role}:{text}"]))
            for t, price, letter, line in moves:
                cand = (cost + price, audit + letter, lines + line)
                if t not in new or cand < new[t]:
                    new[t] = cand
        best = new
    cost, audit, lines = min(v for s, v in inserted(best).items() if s in ("", "a"))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, *faults, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def conversations(seed, n, longest=12):
    rng, rows = random.Random(seed), []
    for conv in range(n):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", ""])
            text = rng.choice(["Yes.", "No!", "cut off", "Why? ", "so on", "", " \n", "done.\t", "é?", f"n {rng.random()}.", f"long {rng.random()}"])
            rows.append((conv, turn if rng.random() > 0.1 else turn + 3, role, text))
    return rows


def got(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect()}


def expected(rows, hurt=True):
    convs = {}
    for r in rows:
        convs.setdefault(r[0], []).append(r)
    return {c: brute(damage(rs) if hurt else [(a, b, " " if x is None else x, " " if y is None else y) for a, b, x, y in rs])
            for c, rs in convs.items()}


def test_against_brute_force(spark, write):
    rows = conversations(1, 150)
    rows += [(None, None, "user", "Hi."), (None, 2, None, None), (None, None, "assistant", "Yes."), (900, 5, None, "no role."),
             (901, 3, "user", None), (902, 1, "user", "x " * 50000 + "."), (903, 1, "system", "Only."), rows[3], rows[4], rows[4]]
    df = write(rows, SCHEMA)
    assert got(C.repair(C.damaged(df), df)) == expected(rows)
    assert got(C.repair(df)) == expected(rows, hurt=False)


def test_conversations_cut_into_many_parts(spark, write, monkeypatch):
    rows = conversations(2, 20, longest=60)
    rng = random.Random(3)
    rows += [(77, None if rng.random() < 0.3 else rng.randint(0, 40), rng.choice(["user", "assistant", "system"]),
              rng.choice(["Yes.", f"t {i}.", f"u {i}", ""])) for i in range(700)]  # most rows in one conversation
    df = write(rows, SCHEMA)
    monkeypatch.setattr(C, "BLOCK_BITS", 3)
    monkeypatch.setattr(C, "PIECE", 50)
    want = expected(rows)
    assert got(C.repair(C.damaged(df), df)) == want
    assert len(want[77][6]) > 600


def test_empty_and_clashing_columns(spark, write):
    none = spark.createDataFrame([], SCHEMA)
    assert C.repair(C.damaged(none), none).collect() == []
    rows = conversations(4, 10)
    df = write([(*r, "a", "b", "c") for r in rows], SCHEMA + ", ck string, kind string, cost string")
    assert got(C.repair(C.damaged(df), df)) == expected(rows)


def test_nothing_left_after_the_damage(spark, write):
    gone = [c for c in range(2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:3]
    df = write([(c, 0, "user", "Hi.") for c in gone], SCHEMA)
    assert got(C.repair(C.damaged(df), df)) == {c: (0, 0, 0, 0, 0, 0, "", EMPTY) for c in gone}


def _full_table(types, enter):
    """Least (cost, audit) of every state, audits as strings."""
    letters = {1: "D", 2: "K", 3: "R"}
    best = {enter: (0, "")}
    for k in types:
        new = {}
        for s, (c, a) in best.items():
            for t in range(4):
                if C.COST[k, s, t] < C.NO_WAY:
                    cand = (c + int(C.COST[k, s, t]), a + "I" * C.INSERTS[k, s, t] + letters[C.EDIT[k, s, t]])
                    new[t] = min(new.get(t, cand), cand)
        best = new
    return best


@pytest.mark.parametrize("seed", range(6))
def test_hirschberg_finds_the_least_audit(seed):
    rng = np.random.default_rng(seed)
    length = rng.integers(1, 40, 60)
    start = np.cumsum(length) - length
    types = rng.integers(0, 9, length.sum())
    enter = rng.integers(0, 4, 60)
    inserts, edits, before, after, ends = C.solve(types, start, length, enter, np.full(60, -1))
    cost, rank = C.forward(types, start, length, enter)
    for i in range(60):
        own = slice(start[i], start[i] + length[i])
        table = _full_table(types[own], enter[i])
        want = min((c + int(C.END_COST[s]), a + "I" * C.END_INSERTS[s]) for s, (c, a) in table.items())
        audit = "".join("I" * n + "~DKR"[e] for n, e in zip(inserts[own], edits[own])) + "I" * C.END_INSERTS[ends[i]]
        spent = int(C.COST[types[own], before[own], after[own]].sum() + C.END_COST[ends[i]])
        assert (spent, audit) == want
        assert [int(c) for c in cost[i] if c < C.NO_WAY] == [table[s][0] for s in sorted(table)]
        known = sorted(table, key=lambda s: table[s][1])
        assert sorted(known, key=lambda s: rank[i][s]) == known
