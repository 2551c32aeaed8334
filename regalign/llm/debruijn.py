"""Substring dedup: repeated token k-mers as edges of a De Bruijn graph, compacted into paths.

A window of ``k`` words is an edge from the node of its first k - 1 words to the node of its last
k - 1.  Texts are never exploded into one row per window.  Consecutive windows whose smallest
inner gram (minimiser) is the same one form a *segment*, a stretch of path of up to k - s + 1
edges.  Equal windows have equal minimisers at the same place, so only segments that share a
minimiser can share an edge:

1. minimisers that occur at two or more places are counted (about one row per 13 words);
2. segments with such a minimiser are written with their nodes and source coordinates;
3. equal segments become one class.  A class seen twice repeats as a whole; the edges of the
   others are compared, edge by edge, with those of the classes under the same minimiser;
4. runs of repeated edges are joined end node to start node where the node does not branch, by
   pointer doubling, so each path gets one id;
5. source coordinates carry the repeated runs back to the documents, where they are merged into
   spans and cut.

An edge is told by its two node hashes (2 x 64 bits) under its minimiser.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regalign.llm.common import binary_list, keyed, materialize, scan, slices

WINDOW = 35
FILTER_BITS = 1 << 24  # fixed size of the minimiser filter: 2 MB at any input size
PIECE = 2 << 20        # bytes of text a task works on at a time
_M = 0x9E3779B97F4A7C15
_INV = pow(_M, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("m", ())) < n:
        size = 1 << max(16, (n - 1).bit_length())
        for name, base in (("m", _M), ("i", _INV)):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            _powers[name] = np.cumprod(p)
    return _powers["m"], _powers["i"]


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def inner_size(k: int) -> int:
    """Words of the inner gram: a third of the window, and at most 62 windows share one."""
    return max(1, min(12, k // 3), k - 61)


class Segments:
    """The segments of some texts: arrays over segments, and the node hashes of all word positions."""

    def __init__(self, texts: list[bytes | None], k: int):
        words: list[bytes] = []
        counts = []
        for t in texts:
            w = t.split() if t else []
            counts.append(len(w))
            words += w
        n, s = len(words), inner_size(k)
        self.first = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)  # first word of each text
        self.k, self.n = k, n
        self.at = np.empty(0, np.int64)
        if n < k:
            return
        m, inv = _power(n + 1)
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=n)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * m[:n])])
        self.inv = inv
        gram = _mix(self.range_hash(np.arange(n - s + 1), s))
        low = np.lib.stride_tricks.sliding_window_view(gram, k - s + 1).argmin(axis=1) + np.arange(n - k + 1)
        doc = np.repeat(np.arange(len(texts)), counts)
        inside = np.flatnonzero(doc[: n - k + 1] == doc[k - 1:])
        if not len(inside):
            return
        new = np.ones(len(inside), dtype=bool)
        new[1:] = (low[inside[1:]] != low[inside[:-1]]) | (np.diff(inside) != 1)
        begin = np.flatnonzero(new)
        self.at = inside[begin]                                             # first word of the first window
        self.windows = np.diff(np.concatenate([begin, [len(inside)]]))      # windows in the segment
        self.doc = doc[self.at]
        self.minimiser = gram[low[self.at]]
        self.offset = low[self.at] - self.at                                # place of the minimiser

    def range_hash(self, start: np.ndarray, size: int | np.ndarray) -> np.ndarray:
        return (self.sums[start + size] - self.sums[start]) * self.inv[start]


def minimisers(texts: DataFrame, k: int) -> DataFrame:
    """(m) one row per segment: its minimiser."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", PIECE):
                s = Segments(binary_list(part.column("text")), k)
                if len(s.at):
                    yield pa.RecordBatch.from_arrays([pa.array(s.minimiser.view(np.int64))], ["m"])

    return texts.select("text").mapInArrow(run, "m long")


def bit_filter(values: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """A bit table of fixed size with the bit of every value of ``m`` set (a value not in it is surely absent).

    At most bits / 64 rows of 16 bytes reach the driver, whatever the input's size.  The more
    values, the less it filters; the result never depends on it.
    """
    place = F.pmod("m", F.lit(bits))
    rows = values.groupBy(F.shiftright(place, 6).alias("w")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (place.bitwiseAND(63)).cast("int"))).alias("b")).toArrow()
    table = np.zeros(bits // 64, dtype=np.uint64)
    table[rows.column("w").to_numpy()] = rows.column("b").to_numpy().view(np.uint64)
    return table


def in_filter(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    place = (values & np.uint64(len(table) * 64 - 1)).astype(np.int64)
    return (table[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) == 1


def segments(texts: DataFrame, k: int, table) -> DataFrame:
    """(m, o, n, c, nodes, _f, _r, a): segments whose minimiser passes the filter, with their source coordinates.

    ``o`` minimiser's place, ``n`` windows, ``c`` hash of the segment's words, ``nodes`` the n + 1
    node hashes, (_f, _r) the row, ``a`` the first word.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = table.value
        for batch in batches:
            for part in slices(batch, "text", PIECE):
                s = Segments(binary_list(part.column("text")), k)
                keep = np.flatnonzero(in_filter(bits, s.minimiser)) if len(s.at) else ()
                if not len(keep):
                    continue
                node = s.range_hash(np.arange(s.n - k + 2), k - 1).tobytes()
                at, n, doc = s.at[keep], s.windows[keep], s.doc[keep]
                nodes = [node[8 * x: 8 * (x + y + 1)] for x, y in zip(at.tolist(), n.tolist())]
                f, r = (part.column(c).to_numpy(zero_copy_only=False)[doc] for c in ("_f", "_r"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s.minimiser[keep].view(np.int64)), pa.array(s.offset[keep].astype(np.int32)),
                     pa.array(n.astype(np.int32)), pa.array(_mix(s.range_hash(at, n + k - 1)).view(np.int64)),
                     pa.array(nodes, type=pa.binary()), pa.array(f), pa.array(r),
                     pa.array((at - s.first[doc]).astype(np.int32))],
                    ["m", "o", "n", "c", "nodes", "_f", "_r", "a"])

    return texts.select("_f", "_r", "text").mapInArrow(
        run, "m long, o int, n int, c long, nodes binary, _f long, _r long, a int")


def edges(classes: DataFrame) -> DataFrame:
    """(m, o, n, c, i, p, u, v, seen): one row per edge of each class; ``p`` is its place under the minimiser."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 20_000):
                part = batch.slice(at, 20_000)
                n = part.column("n").to_numpy(zero_copy_only=False).astype(np.int64)
                node = np.frombuffer(b"".join(part.column("nodes").to_pylist()), dtype=np.int64)
                row = np.repeat(np.arange(len(n)), n)
                i = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                begin = (np.cumsum(n + 1) - (n + 1))[row] + i
                cols = {c: part.column(c).to_numpy(zero_copy_only=False)[row] for c in ("m", "o", "n", "c", "seen")}
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols["m"]), pa.array(cols["o"]), pa.array(cols["n"]), pa.array(cols["c"]),
                     pa.array(i.astype(np.int32)), pa.array((cols["o"] - i).astype(np.int32)),
                     pa.array(node[begin]), pa.array(node[begin + 1]), pa.array(cols["seen"])],
                    ["m", "o", "n", "c", "i", "p", "u", "v", "seen"])

    return classes.select("m", "o", "n", "c", "nodes", "seen").mapInArrow(
        run, "m long, o int, n int, c long, i int, p int, u long, v long, seen long")


CLASS = ["m", "o", "n", "c"]


def repeated_classes(segs: DataFrame) -> DataFrame:
    """(m, o, n, c, nodes, mask): classes with a repeated edge; bit i of ``mask``: its i-th edge repeats."""
    classes = materialize(
        segs.groupBy(*CLASS).agg(F.count(F.lit(1)).alias("seen"), F.first("nodes").alias("nodes")), "classes")
    per = classes.groupBy("m").agg(F.count(F.lit(1)).alias("classes"), F.min("seen").alias("least"))
    unsure = per.where((F.col("classes") > 1) & (F.col("least") == 1)).select("m")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("i"))
    each = edges(classes.join(unsure, "m", "left_semi"))
    key = ["m", "p", "u", "v"]
    twice = each.groupBy(*key).agg(F.sum("seen").alias("all")).where(F.col("all") > 1).select(*key)
    found = each.where(F.col("seen") == 1).join(twice, key).groupBy(*CLASS).agg(F.bit_or(one).alias("mask"))
    whole = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("n")) - F.lit(1).cast("long")
    single = classes.where(F.col("seen") == 1).join(found, CLASS).select(*CLASS, "nodes", "mask")
    return classes.where(F.col("seen") > 1).select(*CLASS, "nodes", whole.alias("mask")).unionByName(single)


def runs(classes: DataFrame) -> DataFrame:
    """(m, o, n, c, i, j, head, tail): stretches of consecutive repeated edges i..j-1 and their end nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("n").to_numpy(zero_copy_only=False).astype(np.int64)
            mask = batch.column("mask").to_numpy(zero_copy_only=False).astype(np.int64)
            if not len(n):
                continue
            width = int(n.max())
            on = np.zeros((len(n), width + 2), dtype=np.int8)
            on[:, 1:-1] = (mask[:, None] >> np.arange(width)) & 1
            step = np.diff(on, axis=1)
            row, i = np.nonzero(step == 1)
            _, j = np.nonzero(step == -1)
            node = np.frombuffer(b"".join(batch.column("nodes").to_pylist()), dtype=np.int64)
            begin = (np.cumsum(n + 1) - (n + 1))[row]
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(batch.column(c).to_numpy(zero_copy_only=False)[row]) for c in CLASS],
                 pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(node[begin + i]),
                 pa.array(node[begin + j])], [*CLASS, "i", "j", "head", "tail"])

    return classes.select(*CLASS, "nodes", "mask").mapInArrow(
        run, "m long, o int, n int, c long, i int, j int, head long, tail long")


def compact(pieces: DataFrame) -> DataFrame:
    """``pieces`` with ``path``: pieces chained through nodes that don't branch share the id of the last one.

    A node joins two pieces if just one distinct piece ends and one starts there.  Links are
    followed by pointer doubling, one join a round, so a chain of n pieces takes log2(n) rounds;
    pieces on a ring never reach an end and keep their own id.
    """
    pieces = materialize(pieces.withColumn("id", F.xxhash64(*CLASS, "i")), "pieces")
    ends = pieces.groupBy("tail").agg(F.count(F.lit(1)).alias("k"), F.first("id").alias("id")).where("k = 1")
    starts = pieces.groupBy("head").agg(F.count(F.lit(1)).alias("k"), F.first("id").alias("next")).where("k = 1")
    link = ends.join(starts, ends["tail"] == starts["head"]).where(F.col("id") != F.col("next")).select("id", "next")
    link = materialize(link, "links")
    total = link.count()
    # a link whose target has no link of its own ends there; the others jump
    for _ in range(math.ceil(math.log2(total + 1)) + 1 if total else 0):
        hop = link.select(F.col("id").alias("next"), F.col("next").alias("after"))
        link = materialize(link.join(hop, "next", "left").select(
            "id", F.coalesce("after", "next").alias("next"), F.col("after").isNull().alias("ended")), "links")
        if link.where(~F.col("ended")).isEmpty():
            break
    if total:
        ended = link.where(F.col("ended")).select("id", F.col("next").alias("path"))
        return pieces.join(ended, "id", "left").withColumn("path", F.coalesce("path", "id"))
    return pieces.withColumn("path", F.col("id"))


def repeated_spans(docs: DataFrame, k: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(texts with a row key, spans): every window of ``k`` words that occurs twice or more, as runs.

    ``spans`` has (_f, _r, start, stop, path): the windows starting at words start..stop-1 of the
    row repeat somewhere (same text included); they cover the words start..stop+k-2.
    """
    spark = docs.sparkSession
    texts = keyed(scan(docs), ["doc_id", "text"])
    twice = materialize(minimisers(texts, k).groupBy("m").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("m"),
                        "minimisers")
    table = spark.sparkContext.broadcast(bit_filter(twice))
    segs = materialize(segments(texts, k, table), "segments")
    pieces = compact(runs(repeated_classes(segs))).select(*CLASS, "i", "j", "path")
    spans = segs.select(*CLASS, "_f", "_r", "a").join(pieces, CLASS).select(
        "_f", "_r", (F.col("a") + F.col("i")).alias("start"), (F.col("a") + F.col("j")).alias("stop"), "path")
    return texts, spans


def cut(texts: DataFrame, spans: DataFrame, k: int, with_text: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256[, text]) for every row, without the words its spans cover."""
    per = spans.groupBy("_f", "_r").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    rows = texts.join(per, ["_f", "_r"], "left").select("doc_id", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", PIECE):
                column = part.column("spans")
                flat = column.flatten()
                start, stop = (flat.field(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in (0, 1))
                sizes = np.array(pa.compute.fill_null(pa.compute.list_value_length(column), 0), dtype=np.int64)
                last = np.cumsum(sizes)
                out = []
                for i, t in enumerate(binary_list(part.column("text"))):
                    words = t.split() if t else []
                    n = len(words)
                    if sizes[i]:
                        a, b = start[last[i] - sizes[i]: last[i]], stop[last[i] - sizes[i]: last[i]]
                        depth = np.zeros(n + 1, dtype=np.int64)
                        np.add.at(depth, a, 1)
                        np.add.at(depth, b + k - 1, -1)
                        words = [words[j] for j in np.flatnonzero(np.cumsum(depth)[:n] == 0).tolist()]
                    kept = b" ".join(words)
                    out.append((n, n - len(words), hashlib.sha256(kept).hexdigest(), kept if with_text else None))
                cols = list(zip(*out)) or [(), (), (), ()]
                arrays = [part.column("doc_id"), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                          pa.array(cols[2], pa.string())]
                if with_text:
                    arrays.append(pa.array(cols[3], pa.binary()).cast(pa.string()))
                yield pa.RecordBatch.from_arrays(arrays, names)

    names = ["doc_id", "n_words", "n_removed", "kept_sha256"] + ["text"] * with_text
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", text string" * with_text
    return rows.withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, k: int = WINDOW, with_text: bool = False) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) without the words covered by a repeated window of ``k`` words.

    A window repeats if its word sequence also starts anywhere else in the table, the same text
    included; all windows are judged on the input, so every copy of a passage goes.  Null, empty
    and short texts have no window and keep their words; repeated rows are copies of each other;
    ids may be null or repeated (rows are told apart by file and position); an empty table gives
    no rows; other columns are not read.  The kept words are joined by single spaces.
    """
    texts, spans = repeated_spans(docs, k)
    return cut(texts, spans, k, with_text)
