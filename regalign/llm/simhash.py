"""SimHash near-duplicates: fingerprints, then exact Hamming neighbours through vantage-point trees.

The 64 bits are cut into blocks.  However the ``max_bits`` differing bits of a pair spread over the
blocks, they leave some block (or union of blocks) with few of them; each such part has a
vantage-point tree with the reach that is needed there, so that every spread is within the reach of
some tree.  A node holds a vantage point and a radius, fingerprints within the radius go inside and
the others outside.  A fingerprint's shard is its home leaf; it also visits every later leaf its
ball of the tree's reach overlaps (triangle bound: inside if d - reach <= radius, outside if
d + reach > radius), all other branches are pruned.  Leaves are then searched exactly on the full
64 bits.

On all 64 bits 4 bits of reach overlap two thirds of the points at every level.  Four blocks need
one tree of reach 1 (a pair that differs in all four blocks has one bit in each) and three of reach
0; the tree with a reach gets the wider block, where a step of one bit overlaps less.  Beyond what
four blocks can hold, unions of two to four blocks are equal in every pair, and the reach is 0.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regalign.llm.common import (
    attach,
    binary_list,
    keyed,
    materialize,
    sampled,
    scan,
    slices,
    unpack,
    with_row_key,
)
from regalign.llm.components import components

HASH_SEED = 42
LEAF = 512            # fingerprints a leaf should hold
PART = 2048           # fingerprints routed at a time
ROUTED = 1 << 18      # leaves they may reach in all, were each to reach every leaf
CELL = 4096           # a fuller leaf is split into pieces of this size, compared pair by pair
TABLE_DEPTH = 12      # levels of a tree that are fitted to the sample; deeper nodes have a hashed vantage point
SAMPLE = 20_000       # fingerprints the fitted vantage points and radii are taken from


def simhash(text: bytes, shingle: int) -> int:
    """64-bit SimHash of the lower-cased (A-Z) words' shingles; no word: 0."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        h = np.array([xxhash.xxh64_intdigest(b" ".join(words), HASH_SEED)], dtype=np.uint64)
    else:
        joined = b" ".join(words)
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        end = np.cumsum(size) + np.arange(len(words))
        start = (end - size)[: len(words) - shingle + 1].tolist()
        digest = xxhash.xxh64_intdigest
        h = np.array([digest(joined[s:e], HASH_SEED) for s, e in zip(start, end[shingle - 1:].tolist())],
                     dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(h), 1 << 16):
        bits = np.unpackbits(h[at:at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                             bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """``docs`` (doc_id, text, ...) with ``fp``, the fingerprint's 64 bits as a signed long (null text: 0), for the text."""
    carried = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                fp = np.array([simhash(t, shingle) if t else 0 for t in binary_list(part.column("text"))],
                              dtype=np.uint64)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in carried], pa.array(fp.view(np.int64))],
                                                 [*carried, "fp"])

    return docs.mapInArrow(run, docs.select(*carried).schema.add("fp", "long"))


def reaches(max_bits: int, blocks: int, together: int) -> list[tuple[tuple[int, ...], int]]:
    """Unions of ``together`` blocks and the reach of each, so that every spread of ``max_bits`` bits is in some reach.

    All reaches start at 0.  Of the spreads still out of reach the nearest are taken first, by the
    union that brings in most of them.  (Fewer bits are in reach wherever more are.)
    """
    unions = list(combinations(range(blocks), together))
    bars = combinations(range(max_bits + blocks - 1), blocks - 1)
    spreads = [[b - a - 1 for a, b in zip((-1, *bar), (*bar, max_bits + blocks - 1))] for bar in bars]
    need = {u: [sum(s[b] for b in u) for s in spreads] for u in unions}
    reach = dict.fromkeys(unions, 0)
    left = [i for i in range(len(spreads)) if min(need[u][i] for u in unions) > 0]
    while left:
        r = min(need[u][i] for u in unions for i in left)
        u = max(unions, key=lambda u: sum(need[u][i] <= r for i in left))
        reach[u] = r
        left = [i for i in left if need[u][i] > r]
    return list(reach.items())


def subspaces(max_bits: int, blocks: int) -> list[tuple[int, int]]:
    """(bit mask, reach) of each tree; blocks under a reach are wider."""
    together = max(1, blocks - max_bits)
    trees = reaches(max_bits, blocks, together)
    share = math.comb(blocks - 1, together - 1)
    weight = [1 + sum(r for u, r in trees if b in u) / share for b in range(blocks)]
    edges = [round(64 * sum(weight[:b]) / sum(weight)) for b in range(blocks + 1)]
    block = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [(sum(block[b] for b in u), r) for u, r in trees]


def blocks_for(n: int, max_bits: int) -> int:
    """Fewest blocks, ``max_bits`` or more, whose trees can hold ``n`` fingerprints in leaves of about CELL."""
    for m in (max(1, max_bits), max_bits + 2, max_bits + 3):
        if n <= CELL * 2 ** min(mask.bit_count() for mask, _ in subspaces(max_bits, m)):
            return m
    return max_bits + 4


def tree_depth(n: int, leaf: int, mask: int, reach: int) -> int:
    """Levels that leave about ``leaf`` of ``n`` values in a leaf, four times as many per bit of reach."""
    return min(mask.bit_count(), max(0, math.ceil(math.log2(max(1, n) / (leaf << (2 * reach))))))


def _mixed(node: np.ndarray, seed: int) -> np.ndarray:
    x = (node.astype(np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Tree:
    """A vantage-point tree over ``value & mask``, heap-ordered (node i has children 2i+1, 2i+2).

    The upper levels are fitted to a sample.  Where that has no values left, and in all deeper
    levels, the vantage point is a hash of the node and the radius the middle distance; so the
    table stays small however deep the tree is.
    """

    def __init__(self, sample: np.ndarray, mask: int, depth: int, seed: int = 5):
        self.mask, self.depth, self.seed = np.uint64(mask), depth, seed
        self.middle = (mask.bit_count() - 1) // 2
        inner = 2 ** min(depth, TABLE_DEPTH) - 1
        self.vantage = _mixed(np.arange(max(inner, 1)), seed) & self.mask
        self.radius = np.full(max(inner, 1), self.middle, dtype=np.int16)
        rng = np.random.default_rng(seed)
        groups = {0: np.unique(sample & self.mask)}
        for node in range(inner):
            values = groups.pop(node, np.empty(0, np.uint64))
            if len(values) < 2:
                continue
            best = None
            for v in values[rng.integers(0, len(values), 5)]:  # the vantage point that halves best
                d = np.bitwise_count(values ^ v).astype(np.int16)
                inside = np.cumsum(np.bincount(d, minlength=65))
                r = int(np.argmin(np.abs(inside - len(values) / 2)))
                off = abs(int(inside[r]) - len(values) / 2)
                if inside[r] < len(values) and (best is None or off < best[0]):
                    best = (off, v, r, d)
            if best is not None:
                _, self.vantage[node], self.radius[node], d = best
                groups[2 * node + 1], groups[2 * node + 2] = values[d <= best[2]], values[d > best[2]]

    def look(self, x: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distance of each value to its node's vantage point, and the node's radius."""
        if len(node) and node[0] >= len(self.vantage):  # all nodes of a step are on one level
            vantage, radius = _mixed(node, self.seed) & self.mask, np.full(len(node), self.middle, dtype=np.int16)
        else:
            vantage, radius = self.vantage[node], self.radius[node]
        return np.bitwise_count((x & self.mask) ^ vantage).astype(np.int16), radius

    def home(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each value."""
        node = np.zeros(len(x), dtype=np.int64)
        for _ in range(self.depth):
            d, r = self.look(x, node)
            node = 2 * node + 1 + (d > r)
        return node

    def reached(self, x: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
        """(index into x, leaf) for every leaf the ball of ``reach`` around a value overlaps."""
        row, node = np.arange(len(x)), np.zeros(len(x), dtype=np.int64)
        for _ in range(self.depth):
            d, r = self.look(x[row], node)
            near, far = d - reach <= r, d + reach > r
            row = np.concatenate([row[near], row[far]])
            node = np.concatenate([2 * node[near] + 1, 2 * node[far] + 2])
        return row, node


def route(fps: DataFrame, trees: list[tuple[Tree, int]]) -> DataFrame:
    """(tree, leaf, fp): each fingerprint in its home leaf, and as a visitor in the later leaves it reaches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for t, (tree, reach) in enumerate(trees):
                # a dense group may reach all leaves of a deep tree
                most = max(1, min(PART, ROUTED >> tree.depth)) if reach else PART
                for part in np.array_split(x, max(1, -(-len(x) // most))):
                    home = tree.home(part)
                    row, leaf = np.arange(len(part)), home
                    if reach:
                        more, at = tree.reached(part, reach)
                        later = at > home[more]  # the earlier leaf's point visits the later one: each pair meets once
                        row, leaf = np.concatenate([row, more[later]]), np.concatenate([leaf, at[later]])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(row), t, dtype=np.int32)), pa.array(leaf),
                         pa.array(part[row].view(np.int64))], ["tree", "leaf", "fp"])

    return fps.select("fp").mapInArrow(run, "tree int, leaf long, fp long")


def linked(x: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """(first, other) for a spanning star of every group of values chained within ``max_bits``; no list of pairs."""
    left = np.unique(x)
    out: list[tuple[int, int]] = []
    while len(left) > 1:
        seed, left = left[0], left[1:]
        queue = [seed]
        while queue and len(left):
            near = np.bitwise_count(left ^ queue.pop()) <= max_bits
            if near.any():
                found = left[near]
                left = left[~near]
                queue.extend(found)
                out.extend((int(seed), int(v)) for v in found)
    return out


def search(cells: DataFrame, max_bits: int) -> DataFrame:
    """Links (a, b) found inside each cell; ``cells`` is partitioned and sorted by (tree, leaf, i, j)."""
    names = ["tree", "leaf", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        key = None

        def flush() -> Iterator[pa.RecordBatch]:
            if sum(map(len, held)) > 1:
                found = np.array(linked(np.concatenate(held), max_bits), dtype=np.uint64).reshape(-1, 2).view(np.int64)
                if len(found):
                    yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            k = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in names])
            x = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            cut = np.flatnonzero((k[:, 1:] != k[:, :-1]).any(axis=0)) + 1
            for part, at in zip(np.split(x, cut), [0, *cut.tolist()]):
                now = tuple(k[:, at].tolist())
                if now != key:
                    yield from flush()
                    held, key = [], now
                held.append(part)
        yield from flush()

    return cells.mapInArrow(run, "a long, b long")


def near_pairs(fps: DataFrame, max_bits: int = 4, blocks: int | None = None, leaf: int = LEAF, cell: int = CELL,
               sample: int = SAMPLE) -> DataFrame:
    """Links (a, b) that connect exactly the fingerprints chained by steps of ``max_bits`` or fewer bits.

    ``fps`` has a column ``fp`` of distinct values.  The trees come from a sample of ``sample``
    values (only balance depends on it, never the result).  A leaf that holds more than ``cell``
    values is cut into pieces by a hash, and every pair of pieces is a cell of its own, so no task
    holds more than two pieces.  Inside a cell a spanning star per group is returned, not all pairs.
    """
    spark = fps.sparkSession
    n = fps.count()
    shapes = subspaces(max_bits, blocks or blocks_for(n, max_bits))
    rows = sampled(fps, "fp", sample, n).select("fp").toPandas()["fp"].to_numpy(dtype=np.int64).view(np.uint64)
    trees = [(Tree(rows, mask, tree_depth(n, leaf, mask, reach), seed=5 + i), reach)
             for i, (mask, reach) in enumerate(shapes)]
    routed = route(fps, trees)
    full = materialize(routed.groupBy("tree", "leaf").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(cell)).cast("int").alias("pieces")).where("pieces > 1"), "full_leaves")
    at = attach(routed, full, ["tree", "leaf"]).withColumn("pieces", F.coalesce("pieces", F.lit(1)))
    at = at.withColumn("p", F.pmod(F.xxhash64("fp"), F.col("pieces")).cast("int")).withColumn(
        "q", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    at = at.select("tree", "leaf", F.least("p", "q").alias("i"), F.greatest("p", "q").alias("j"), "fp")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    at = at.repartition(parts, "tree", "leaf", "i", "j").sortWithinPartitions("tree", "leaf", "i", "j")
    return search(at, max_bits)


def groups(fps: DataFrame, max_bits: int, blocks: int | None, leaf: int, cell: int) -> DataFrame:
    """(fp, root, first, n) per distinct fingerprint: the root of its component, its smallest id and its rows."""
    each = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")),
                       "fingerprints")
    roots = components(near_pairs(each, max_bits, blocks, leaf, cell)).withColumnRenamed("node", "fp")
    return each.join(roots, "fp", "left").withColumn("linked", F.col("root").isNotNull()).withColumn(
        "root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, blocks: int | None = None, leaf: int = LEAF,
                    cell: int = CELL) -> DataFrame:
    """(doc_id, fp, component_id, fingerprint) for every row of ``docs`` (doc_id, text).

    Two rows are linked if their fingerprints differ in at most ``max_bits`` bits; ``component_id``
    is the smallest id reachable.  Equal fingerprints are searched once.  Null, empty and blank
    texts have fingerprint 0 and are linked like any other; repeated rows keep their rows; a null
    id is null in the result and counts as an id only if a whole component has no other.  An
    empty table gives no rows; other columns of ``docs`` are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    fps = materialize(fingerprints(docs, shingle), "simhash")
    each = materialize(groups(fps, max_bits, blocks, leaf, cell), "groups")
    # a fingerprint that is neither linked nor shared is its own component
    shared = each.where(F.col("linked") | (F.col("n") > 1))
    smallest = shared.groupBy("root").agg(F.min("first").alias("component_id"))
    ids = shared.join(smallest, "root").select("fp", "component_id")
    out = attach(fps, materialize(ids, "shared"), ["fp"], salts=8)
    return out.select("doc_id", "fp", F.coalesce("component_id", "doc_id").alias("component_id"),
                      F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"))


def one_of_each(docs: DataFrame, shingle: int = 4, max_bits: int = 4, blocks: int | None = None, leaf: int = LEAF,
                cell: int = CELL) -> DataFrame:
    """The rows of ``docs``, with all their columns, without all but one of each near-duplicate component.

    The row with the smallest id stays (null ids last; of equal ids the first by file and place).
    Only the rows that go are listed, and only their keys meet the texts again.
    """
    docs = scan(docs)
    texts = keyed(docs, [F.col("doc_id").cast("long").alias("doc_id"), "text"])
    fps = materialize(fingerprints(texts, shingle), "simhash")
    each = groups(fps, max_bits, blocks, leaf, cell)
    shared = materialize(each.where(F.col("linked") | (F.col("n") > 1)).select("fp", "root"), "shared")
    rows = materialize(attach(fps, shared, ["fp"], how="inner", salts=8).select("root", "doc_id", "_f", "_r"), "members")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_f", "_r")
    stays = rows.groupBy("root").agg(F.min(place).alias("x")).select(
        F.col("x._f").alias("_f"), F.col("x._r").alias("_r"), F.lit(True).alias("stays"))
    goes = attach(rows.select("_f", "_r"), stays, ["_f", "_r"], salts=1).where(F.col("stays").isNull())
    goes = materialize(goes.select("_f", "_r", F.lit(True).alias("_gone")), "gone")
    kept = attach(with_row_key(docs), goes, ["_f", "_r"], salts=1).where(F.col("_gone").isNull())
    return unpack(kept, docs.columns)
