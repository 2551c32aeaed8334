"""Conversation structure repair: cheapest edits to alternating turns, by Hirschberg's divide and conquer.

Rows of a conversation are edited (Keep, Rerole, Delete, Insert) until the initials of their roles
read ``(s?(ua)+)?``.  Four states say where a prefix stands: 0 nothing yet, 1 after s, 2 after u, 3
after a.  What an edit costs and where it leads depends on the state and the row's type only, so a
stretch of rows maps a four-state cost vector to another one.

The path is found in linear space: a forward vector from the start and a backward vector from the
end meet at the middle row, the crossing state is fixed, and both halves are solved alike.  All
stretches of a level, of all conversations at hand, take their steps together as numpy arrays.

Ties go to the audit (the edits' initials) that is least in ASCII order.  The forward pass carries
the rank of each state's least audit beside its cost.  That is enough to choose the crossing: audits
of different states at one row are different strings, and as both end with the edit that consumes
that row, neither is the beginning of the other; so whichever is less stays less.

A conversation of any length.  Rows are sorted by conversation and turn over all tasks and cut into
blocks of ``BLOCK`` rows; a conversation that crosses a cut has several parts.  Each part gives a
4 x 4 cost matrix with ranks, 32 small numbers; the same recurrence over a conversation's matrices
fixes the states at the cuts, and then each part is solved on its own.  Only the digest of a
repaired conversation is sequential, as a hash must be: it reads the parts' texts as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regalign.llm.common import BLANKS, attach, materialize
from regalign.session import parallelism

#: Rows of a block, as a power of two; a part of a conversation has at most that many.
BLOCK_BITS = 10
#: A batch of parts solved together.
BATCH_ROWS, BATCH_BYTES = 1 << 16, 16 << 20
#: Bytes of a piece of repaired text on its way to the digest.
PIECE = 1 << 20

# What the edits cost.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
NO_WAY = 1 << 40

_NEXT = (2, 2, 3, 2)  # the state after an inserted or reroled row
_ROLE = {2: "user", 3: "assistant"}
#: Cost and inserts to finish in each state: nothing, u and a, a, nothing.
END_COST, END_INSERTS = np.array([0, 2 * INSERT, INSERT, 0]), (0, 2, 1, 0)


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per row type, state before and state after: cost, order among the states after, inserts, edit.

    Type 0 must be deleted; 1 to 4 hold initial s, u, a or another; 5 to 8 the same, truncated.
    """
    cost = np.full((9, 4, 4), NO_WAY, np.int64)
    text = np.full((9, 4, 4), "~", object)  # after every audit
    for kind in range(9):
        extra = TRUNCATED if kind > 4 else 0
        initial = "?suao"[(kind - 1) % 4 + 1] if kind else "?"
        for before in range(4):
            at = before
            for inserts in range(3):  # a third insert would only return to the state after the first
                moves = [("D", at, DELETE)]
                if kind:
                    moves.append(("R", _NEXT[at], REROLE + extra))
                    if (initial == "s" and at == 0) or (initial == "u" and _NEXT[at] == 2) or (initial == "a" and at == 2):
                        moves.append(("K", {"s": 1, "u": 2, "a": 3}[initial], extra))
                for letter, after, price in moves:
                    new = (INSERT * inserts + price, "I" * inserts + letter)
                    if new < (cost[kind, before, after], text[kind, before, after]):
                        cost[kind, before, after], text[kind, before, after] = new
                at = _NEXT[at]
    order = np.array([[[sorted(row).index(x) for x in row] for row in text[kind]] for kind in range(9)])
    inserts = np.array([[[x.count("I") for x in row] for row in text[kind]] for kind in range(9)])
    edit = np.array([[["~DKR".index(x[-1]) for x in row] for row in text[kind]] for kind in range(9)])
    return cost, order, inserts, edit


COST, ORDER, INSERTS, EDIT = _tables()


def _lockstep(lengths: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(step, stretches still going), for stretches sorted by falling length."""
    for step in range(int(lengths[0]) if len(lengths) else 0):
        yield step, np.arange(np.searchsorted(-lengths, -step, side="left"))


def forward(types: np.ndarray, start: np.ndarray, length: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cost, rank of the least audit) of every state after each stretch entered in ``state``."""
    by = np.argsort(-length, kind="stable")
    begin, state = start[by], state[by]
    cost = np.full((len(by), 4), NO_WAY, np.int64)
    rank = np.tile(np.arange(4), (len(by), 1))
    cost[np.arange(len(by)), state] = 0
    for step, at in _lockstep(length[by]):
        kind = types[begin[at] + step]
        key = (cost[at][:, :, None] + COST[kind]) * 4 + rank[at][:, :, None]
        came = key.argmin(1)  # the state before, for each state after
        cost[at] = np.minimum(np.take_along_axis(key, came[:, None], 1)[:, 0] // 4, NO_WAY)
        code = np.take_along_axis(rank[at], came, 1) * 4 + ORDER[kind[:, None], came, np.arange(4)[None]]
        code = code + 16 * (cost[at] >= NO_WAY)
        rank[at] = (code[:, None, :] < code[:, :, None]).sum(2)
    back = np.argsort(by, kind="stable")
    return cost[back], rank[back]


def backward(types: np.ndarray, start: np.ndarray, length: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Cost from every state before each stretch to its end, with the costs ``end`` of the states after it."""
    by = np.argsort(-length, kind="stable")
    last, cost = (start + length - 1)[by], end[by].astype(np.int64)
    for step, at in _lockstep(length[by]):
        kind = types[last[at] - step]
        cost[at] = np.minimum((COST[kind] + cost[at][:, None, :]).min(2), NO_WAY)
    return cost[np.argsort(by, kind="stable")]


def _only(state: np.ndarray) -> np.ndarray:
    end = np.full((len(state), 4), NO_WAY, np.int64)
    end[np.arange(len(state)), state] = 0
    return end


def finish(cost: np.ndarray, rank: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The cheapest state of each row of costs, the audit-least among equals."""
    return ((cost + end) * 4 + rank).argmin(1)


def hirschberg(types: np.ndarray, start: np.ndarray, length: np.ndarray, enter: np.ndarray, leave: np.ndarray) -> np.ndarray:
    """The state before every row on the audit-least cheapest path of each stretch."""
    before = np.zeros(len(types), np.int8)
    while len(start):
        one = length == 1
        before[start[one]] = enter[one]
        start, length, enter, leave = (x[length > 1] for x in (start, length, enter, leave))
        if not len(start):
            break
        half = length // 2
        cost, rank = forward(types, start, half, enter)
        rest = backward(types, start + half, length - half, _only(leave))
        cross = finish(cost, rank, rest)
        start, length, enter, leave = (np.concatenate(x) for x in (
            (start, start + half), (half, length - half), (enter, cross), (cross, leave)))
    return before


def solve(types: np.ndarray, start: np.ndarray, length: np.ndarray, enter: np.ndarray, leave: np.ndarray):
    """Per row (inserts before it, edit 1 D, 2 K, 3 R, state before, state after); per stretch the state it ends in.

    ``leave`` is the state a stretch ends in, or -1 for the cheapest accepted end.
    """
    free = leave < 0
    leave = leave.copy()
    if free.any():
        cost, rank = forward(types, start[free], length[free], enter[free])
        leave[free] = finish(cost, rank, END_COST[None, :])
    before = hirschberg(types, start, length, enter, leave)
    after = np.append(before[1:], 0)
    after[start + length - 1] = leave
    return INSERTS[types, before, after], EDIT[types, before, after], before, after, leave


# ------------------------------------------------------------------ Spark
def damaged(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """Test damage by crc32 of ``conv_id:turn`` modulo 20 (nulls are one space): 0 drops a row, 1 empties its
    text, 2 removes its ``.!?``, 3 repeats it, 4 makes it a user's.  Columns conv_id, turn, role, text."""
    blank = F.lit(" ")
    rows = conversations.select(F.col(conv_id).alias("conv_id"), F.col(turn).cast("long").alias("turn"),
                                F.coalesce(role, blank).alias("role"), F.coalesce(text, blank).alias("text"))
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    rows = rows.withColumn("_d", F.crc32(key.cast("binary")) % 20).where("_d <> 0")
    hit = F.col("_d")
    out = rows.select(
        "conv_id", "turn", F.when(hit == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(hit == 1, F.lit("")).when(hit == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(hit == 3, 2).otherwise(1))).alias("_n"))
    return out.drop("_n")


def _key(column: str) -> Column:
    """A conversation's key: never null."""
    return F.coalesce(F.concat(F.lit("c"), F.col(column).cast("string")), F.lit(""))


def _prepared(rows: DataFrame) -> DataFrame:
    """Rows in order over all tasks, written once: key, place (_mid), block (_seg) and row type."""
    spark = rows.sparkSession
    rows = rows.select(_key("conv_id").alias("ck"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
                       F.coalesce("text", F.lit(" ")).alias("text"))
    rows = rows.withColumn("h", F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text").cast("binary"), 256))
    order = [F.col("ck"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("h")]
    placed = materialize(rows.repartitionByRange(parallelism(spark), *order).sortWithinPartitions(*order).withColumn(
        "_mid", F.monotonically_increasing_id()), "turns").withColumn("_seg", F.shiftright("_mid", BLOCK_BITS))
    blank = F.rtrim("text", F.lit(BLANKS)) == ""
    # only repeated texts need their first place; a text said very often is one row here
    first = materialize(placed.where(~blank).groupBy("ck", "h").agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n")).where(
        "_n > 1").drop("_n"), "first")
    placed = attach(placed, first, ["ck", "h"])
    again = ~blank & (F.col("_first") < F.col("_mid"))
    cut = ~F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1)).isin(".", "!", "?")
    letter = F.substring("role", 1, 1)
    base = F.when(letter == "s", 1).when(letter == "u", 2).when(letter == "a", 3).otherwise(4)
    kind = F.when(blank | F.coalesce(again, F.lit(False)), 0).otherwise(base + F.when(cut, 4).otherwise(0))
    fault = F.when(blank, 1).when(again, 2).when(cut, 3).otherwise(0)
    return placed.select("ck", "_seg", "_mid", "turn", "role", "text", kind.cast("int").alias("kind"), fault.cast("int").alias("fault"))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole parts: rows come sorted by (ck, _seg, _mid), a part may cross batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        for at in range(0, batch.num_rows, 1 << BLOCK_BITS):  # pieces, so that long texts don't pile up
            piece = batch.slice(at, 1 << BLOCK_BITS)
            held.append(piece)
            if sum(b.num_rows for b in held) < BATCH_ROWS and sum(b.nbytes for b in held) < BATCH_BYTES:
                continue
            table = pa.Table.from_batches(held)
            where = _starts(table)
            if len(where) > 1:  # the last part may go on
                yield table.slice(0, where[-1])
                held = table.slice(where[-1]).to_batches()
    if held:
        yield pa.Table.from_batches(held)


def _starts(table: pa.Table) -> np.ndarray:
    ck, seg = table.column("ck").to_pylist(), table.column("_seg").to_pylist()
    return np.array([i for i in range(len(ck)) if i == 0 or ck[i] != ck[i - 1] or seg[i] != seg[i - 1]], dtype=np.int64)


def _bounds(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    start = _starts(table)
    return start, np.diff(np.append(start, table.num_rows))


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(ck, _seg, cost and rank from every state to every state) of each part."""
    for table in _parts(batches):
        types = table.column("kind").to_numpy().astype(np.int64)
        start, length = _bounds(table)
        cost, rank = zip(*[forward(types, start, length, np.full(len(start), s)) for s in range(4)])
        at = pa.array(start)
        yield pa.RecordBatch.from_pydict({
            "ck": table.column("ck").take(at).combine_chunks(), "_seg": table.column("_seg").take(at).combine_chunks(),
            "cost": pa.array(np.stack(cost, 1).reshape(-1, 16).tolist(), pa.list_(pa.int64())),
            "rank": pa.array(np.stack(rank, 1).reshape(-1, 16).tolist(), pa.list_(pa.int64()))})


def _cuts(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """The states at the cuts of one conversation: one small row per ``2**BLOCK_BITS`` of its rows."""
    table = table.sort_by("_seg")
    cost = np.array(table.column("cost").to_pylist(), np.int64).reshape(-1, 4, 4)
    rank = np.array(table.column("rank").to_pylist(), np.int64).reshape(-1, 4, 4)
    ahead = [END_COST]
    for c in cost[::-1]:
        ahead.append(np.minimum((c + ahead[-1][None, :]).min(1), NO_WAY))
    state, enter, leave = 0, [], []
    for c, r, rest in zip(cost, rank, ahead[-2::-1]):
        enter.append(state)
        state = int(((c[state] + rest) * 4 + r[state]).argmin())
        leave.append(state)
    n = len(enter)
    return pa.table({"ck": pa.array([key[0].as_py()] * n, pa.string()), "_seg": table.column("_seg"),
                     "enter": pa.array(enter, pa.int32()), "leave": pa.array(leave, pa.int32()),
                     "last": pa.array([i == n - 1 for i in range(n)])})


_LEGAL = {"su", "ua", "au"}
_SOLVED = ("ck string, _seg long, part int, blank long, duplicate long, truncated long, illegal long, cost long, "
           "audit string, first string, final string, digest string, data binary")


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each part's counts, edits and repaired text: the digest of a whole conversation, else pieces of text."""
    names = [f.split()[0] for f in _SOLVED.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    schema = pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in _SOLVED.split(", ")])
    for table in _parts(batches):
        types = table.column("kind").to_numpy().astype(np.int64)
        start, length = _bounds(table)
        leave = table.column("leave").to_numpy().astype(np.int64)[start]
        inserts, edits, before, after, ends = solve(types, start, length, table.column("enter").to_numpy().astype(np.int64)[start], leave)
        paid = COST[types, before, after]
        ck, seg, last = (table.column(c).to_pylist() for c in ("ck", "_seg", "last"))
        fault, roles = table.column("fault").to_numpy(), table.column("role").to_pylist()
        texts = table.column("text")
        rows = []
        for i, (a, n) in enumerate(zip(start.tolist(), length.tolist())):
            whole = leave[i] < 0
            audit, lines = [], []
            initials = [r[:1] for r in roles[a:a + n]]
            for at in range(a, a + n):
                state = before[at]
                for _ in range(inserts[at]):
                    state = _NEXT[state]
                    lines.append(_ROLE[state] + ":")
                edit = edits[at]
                audit.append("I" * inserts[at] + "~DKR"[edit])
                if edit > 1:
                    lines.append((roles[at] if edit == 2 else _ROLE[_NEXT[state]]) + ":" + texts[at].as_py())
            spent = int(paid[a:a + n].sum())
            if last[a]:
                state = ends[i]
                for _ in range(END_INSERTS[state]):
                    state = _NEXT[state]
                    lines.append(_ROLE[state] + ":")
                audit.append("I" * END_INSERTS[ends[i]])
                spent += int(END_COST[ends[i]])
            data = "\n".join(lines).encode()
            pieces = [b""] if whole else [data[at:at + PIECE] for at in range(0, len(data), PIECE)] or [b""]
            faults = np.bincount(fault[a:a + n], minlength=4)
            illegal = sum(x + y not in _LEGAL for x, y in zip(initials, initials[1:]))
            for part, piece in enumerate(pieces):
                head = part == 0
                counts = [int(f) for f in faults[1:4]] + [illegal, spent] if head else [0] * 5
                # first and final: initials at the ends; part 0 says whether the part holds any line
                rows.append((ck[a], seg[a], part, *counts, "".join(audit) if head else "", initials[0], initials[-1],
                             hashlib.sha256(data).hexdigest() if whole else ("lines" if lines else ""), piece))
        yield pa.RecordBatch.from_pydict({k: pa.array(v, schema.field(k).type) for k, v in zip(names, zip(*rows))}, schema=schema)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation of several parts; rows come sorted by (ck, _seg, part) and are read as a stream."""
    schema = pa.schema([("ck", pa.string()), *[(c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
                        ("audit", pa.string()), ("digest", pa.string())])

    def row(now) -> pa.RecordBatch:
        values = [now["ck"], *now["sum"], "".join(now["audit"]), now["hash"].hexdigest()]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)

    now = None
    for batch in batches:
        for r in batch.to_pylist():
            if now is None or now["ck"] != r["ck"]:
                if now:
                    yield row(now)
                now = {"ck": r["ck"], "sum": [0] * 5, "audit": [], "hash": hashlib.sha256(), "final": None, "any": False}
            for i, c in enumerate(("blank", "duplicate", "truncated", "illegal", "cost")):
                now["sum"][i] += r[c]
            if r["part"] == 0:
                now["audit"].append(r["audit"])
                now["sum"][3] += now["final"] is not None and now["final"] + r["first"] not in _LEGAL
                now["final"] = r["final"]
                if r["digest"]:  # the part holds lines
                    if now["any"]:
                        now["hash"].update(b"\n")
                    now["any"] = True
            now["hash"].update(r["data"])
    if now:
        yield row(now)


def repair(rows: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 per conversation.

    ``rows`` has conv_id, turn, role and text (other columns are ignored).  A conversation's rows are
    taken by turn, nulls first, equal turns by role and then by a hash of role and text.  A null role
    or text is one space.  Each row's first fault counts: blank (nothing but ASCII blanks),
    duplicate (role and text seen earlier) or truncated (its last other character is none of
    ``.!?``); ``illegal`` are neighbours whose initials aren't su, ua or au; ``gaps`` the turn
    numbers missing between the least and the greatest.  A null conv_id is a conversation of its
    own.  With ``conversations`` every conv_id of it gets a row: one without rows has zeros, an
    empty audit and the digest of an empty text.  Empty tables give an empty result.
    """
    spark = rows.sparkSession
    tasks = parallelism(spark)
    placed = _prepared(rows)
    span = placed.groupBy("ck").agg(
        F.min("_seg").alias("_lo"), F.max("_seg").alias("_hi"), F.max("turn").alias("_max"), F.min("turn").alias("_min"),
        F.count_distinct("turn").alias("_n"))
    span = materialize(span, "spans")
    several = span.where("_lo < _hi").select("ck", F.lit(1).alias("_several"))
    some = attach(placed.select("ck", "_seg", "_mid", "kind"), several, ["ck"], how="inner")
    parts = some.repartition(tasks, "ck", "_seg").sortWithinPartitions("ck", "_seg", "_mid").mapInArrow(
        _matrices, "ck string, _seg long, cost array<long>, rank array<long>")
    cuts = materialize(parts.groupBy("ck").applyInArrow(_cuts, "ck string, _seg long, enter int, leave int, last boolean"), "cuts")
    full = attach(placed, cuts, ["ck", "_seg"], salts=1).select(
        "ck", "_seg", "_mid", "role", "text", "kind", "fault", F.coalesce("enter", F.lit(0)).alias("enter"),
        F.coalesce("leave", F.lit(-1)).alias("leave"), F.coalesce("last", F.lit(True)).alias("last"))
    done = materialize(full.repartition(tasks, "ck", "_seg").sortWithinPartitions("ck", "_seg", "_mid").mapInArrow(_solved, _SOLVED), "solved")
    out = ["ck", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "digest"]
    alone = done.where(F.length("digest") == 64).select(*out)
    joined = done.where(F.length("digest") < 64).repartition(tasks, "ck").sortWithinPartitions("ck", "_seg", "part").mapInArrow(
        _joined, "ck string, blank long, duplicate long, truncated long, illegal long, cost long, audit string, digest string")
    gaps = F.coalesce(F.col("_max") - F.col("_min") + 1 - F.col("_n"), F.lit(0)).cast("long")
    found = alone.unionByName(joined).join(span.select("ck", gaps.alias("gaps")), "ck")
    every = (conversations if conversations is not None else rows).select("conv_id").distinct().withColumn("ck", _key("conv_id"))
    nothing = hashlib.sha256(b"").hexdigest()
    return every.join(found, "ck", "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("digest", F.lit(nothing)).alias("repaired_sha256"))
