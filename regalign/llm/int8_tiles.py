"""Embedding near-duplicates by int8 tile products with error bounds.

Every vector is scaled to unit length and rounded to int8 with a scale of its own, x = s q + e.  For
two of them

    |x . y - s_x s_y q_x . q_y| <= |e_x| |s_y q_y| + |x| |e_y| <= |e_x| (1 + |e_y|) + |e_y|,

so the norm of a vector's rounding error, kept with it, bounds the error of all its products.  The
integer products of a tile of vectors with another are one matrix product.  A pair whose product
plus bound stays under the threshold is no link, one whose product minus bound reaches it is one,
and only the pairs between are worked out again from the stored components in double precision.

Shape of the job.  Vectors are packed into tiles of ``TILE`` rows, one row of a table each, and the
tiles are dealt into G groups.  Cell (a, b), a <= b, multiplies the tiles of two groups, so a tile is
copied to G cells and every pair of vectors meets in exactly one.  A cell returns one row per vector
with a link: how many it found and its component among the vectors of the cell.  Pairs are never
rows, whatever the size of a group of copies.  The work is quadratic in the vectors, as it must be
for vectors spread evenly: no bound separates them (nearest-pivot cells overlap all others at 64
components), only multiply-adds get cheaper.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regalign.llm.common import attach, materialize
from regalign.llm.components import components
from regalign.session import parallelism

#: Vectors of a tile; a vector's number is its tile's number times this plus its place.
TILE = 1024
#: Bytes of one side of a cell: a task holds two sides and the products of two tiles.
SIDE_BYTES = 48 << 20
#: Cells a core gets, so that cells of unequal size even out.
CELLS_PER_CORE = 4
#: Allowance for rounding in double precision around the bounds.
SLACK = 1e-9

_TILES = "dim int, n int, ids array<long>, q binary, scale binary, err binary, raw binary"


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(q int8, scale, bound on the norm of the rounding error) of unit vectors."""
    scale = np.abs(x).max(1) / 127.0
    q = np.rint(x / scale[:, None]).astype(np.int8)
    left = x - q * scale[:, None]
    return q, scale, np.sqrt((left * left).sum(1)) * (1 + SLACK) + SLACK


def unit(raw: np.ndarray) -> np.ndarray:
    return raw / np.sqrt((raw * raw).sum(1))[:, None]


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tiles of the vectors of a partition, by number of components; dim 0 holds those that link with nothing."""
    waiting: dict[int, list[tuple[list, np.ndarray]]] = {}

    def out(dim: int) -> pa.RecordBatch:
        parts = waiting.pop(dim)
        ids = [i for part, _ in parts for i in part]
        rest, ids = ids[TILE:], ids[:TILE]
        raw = np.concatenate([x for _, x in parts]) if dim else np.zeros((len(ids), 0))
        if rest:
            waiting[dim] = [(rest, raw[TILE:])]
        raw = raw[:TILE]
        q, scale, err = quantise(unit(raw)) if dim else (raw.astype(np.int8), np.zeros(0), np.zeros(0))
        small = raw.astype(np.float32)
        raw = small if (small == raw).all() else raw  # single precision where nothing is lost
        return pa.RecordBatch.from_pydict({
            "dim": pa.array([dim], pa.int32()), "n": pa.array([len(ids)], pa.int32()), "ids": pa.array([ids], pa.list_(pa.int64())),
            **{k: pa.array([a.tobytes()], pa.binary()) for k, a in (("q", q), ("scale", scale), ("err", err), ("raw", raw))}})

    for batch in batches:
        ids, lists = batch.column(0).to_pylist(), batch.column(1)
        sizes = np.array(pa.compute.fill_null(pa.compute.list_value_length(lists), 0), dtype=np.int64)
        for dim in np.unique(sizes):
            rows = np.flatnonzero(sizes == dim)
            good = np.zeros(len(rows), bool)
            if dim:
                values = pa.compute.list_flatten(lists.take(pa.array(rows))).to_numpy(zero_copy_only=False)
                x = values.astype(np.float64).reshape(-1, dim)  # a null becomes nan
                top = np.abs(x).max(1)
                good = np.isfinite(top) & (top > 0)
                # by a power of two, which loses no bit, so that squares neither overflow nor vanish
                x = np.ldexp(x[good], -np.frexp(top[good])[1][:, None].astype(np.int32))
                if good.any():
                    waiting.setdefault(int(dim), []).append(([ids[i] for i in rows[good]], x))
            if not good.all():
                waiting.setdefault(0, []).append(([ids[i] for i in rows[~good]], np.zeros(0)))
        for dim in list(waiting):
            while dim in waiting and sum(len(p) for p, _ in waiting[dim]) >= TILE:
                yield out(dim)
    for dim in list(waiting):
        while dim in waiting:
            yield out(dim)


class _Tile:
    def __init__(self, tile: int, dim: int, n: int, q: bytes, scale: bytes, err: bytes, raw: bytes):
        self.node = tile * TILE + np.arange(n)
        # products of int8 add up exactly in single precision up to 1,040 components
        self.q = np.frombuffer(q, np.int8).reshape(n, dim).astype(np.float32 if dim <= 1040 else np.float64)
        self.scale, self.err = np.frombuffer(scale), np.frombuffer(err)
        self.raw = np.frombuffer(raw, np.float32 if len(raw) == 4 * n * dim else np.float64).reshape(n, dim)


def linked(a: _Tile, b: _Tile, threshold: float, stats: dict | None = None) -> np.ndarray:
    """Boolean matrix of the pairs (row of ``a``, row of ``b``) with cosine at or above the threshold."""
    p = a.q @ b.q.T
    rough = p * a.scale.astype(p.dtype)[:, None] * b.scale.astype(p.dtype)[None, :]
    most = a.err.max() * (1 + b.err.max()) + b.err.max() + 1e-5  # the last term covers single precision
    i, j = np.nonzero(rough >= threshold - most)
    exact = p[i, j].astype(np.float64) * a.scale[i] * b.scale[j]
    off = a.err[i] * (1 + b.err[j]) + b.err[j] + SLACK
    out = np.zeros(p.shape, bool)
    sure = exact - off >= threshold
    out[i[sure], j[sure]] = True
    open_ = np.flatnonzero(~sure & (exact + off >= threshold))
    for at in range(0, len(open_), 1 << 16):
        r, c = i[open_[at:at + (1 << 16)]], j[open_[at:at + (1 << 16)]]
        x, y = a.raw[r].astype(np.float64), b.raw[c].astype(np.float64)
        cos = (x * y).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum(1)))
        out[r[cos >= threshold], c[cos >= threshold]] = True
    if stats is not None:
        stats["pairs"] = stats.get("pairs", 0) + p.size
        stats["again"] = stats.get("again", 0) + len(open_)
    return out


def _least(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest vertex of each vertex's component, for edges (a, b) among n vertices."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        for at in (label[a], label[b]):  # hook the roots, then shorten all paths
            np.minimum.at(new, at, low)
        while (new[new] != new).any():
            new = new[new]
        apart = new[a] != new[b]
        a, b, label = a[apart], b[apart], new
    return label


def _spanning(hits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """At most rows + columns links that connect what the links of a tile pair connect."""
    if hits.sum() <= sum(hits.shape):
        return np.nonzero(hits)
    rows, cols = np.flatnonzero(hits.any(1)), np.flatnonzero(hits.any(0))
    dense = hits[np.ix_(rows, cols)]
    n = len(rows)
    label, ea, eb = np.arange(n + len(cols)), [], []
    apart = dense
    while apart.any():  # every row and column takes its first link to another part: the parts at least halve
        r, c = np.flatnonzero(apart.any(1)), np.flatnonzero(apart.any(0))
        ea += [r, apart[:, c].argmax(0)]
        eb += [apart[r].argmax(1), c]
        label = _least(n + len(cols), np.concatenate(ea), np.concatenate(eb) + n)
        apart = dense & (label[:n, None] != label[None, n:])
    return rows[np.concatenate(ea)], cols[np.concatenate(eb)]


def _cell(threshold: float):
    """All tile pairs of a cell: (node, n_links, root among the cell's vectors) of each vector with a link."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        same = key[1].as_py() == key[2].as_py()
        rows = sorted(table.select(["side", "tile", "dim", "n", "q", "scale", "err", "raw"]).to_pylist(), key=lambda r: (r["side"], r["tile"]))
        sides = [[_Tile(**{k: v for k, v in r.items() if k != "side"}) for r in rows if r["side"] == s] for s in (0, 1)]
        left, right = sides[0], sides[0] if same else sides[1]
        tiles = left if same else left + right
        start = {id(t): n for t, n in zip(tiles, np.cumsum([0, *[len(t.node) for t in tiles]]))}
        total = sum(len(t.node) for t in tiles)
        count, ea, eb, held = np.zeros(total, np.int64), [], [], 0
        for i, a in enumerate(left):
            for b in right[i:] if same else right:
                hits = linked(a, b, threshold)
                if not hits.any():
                    continue
                at, to = start[id(a)], start[id(b)]
                if a is b:  # a vector doesn't link with itself; each pair counts for both of its vectors
                    np.fill_diagonal(hits, False)
                    hits |= hits.T
                    count[at:at + len(a.node)] += hits.sum(1)
                else:
                    count[at:at + len(a.node)] += hits.sum(1)
                    count[to:to + len(b.node)] += hits.sum(0)
                r, c = _spanning(hits)
                ea.append(r + at)
                eb.append(c + to)
                held += len(r)
                if held > 4 * total + (1 << 20):  # keep a spanning star per component
                    label = _least(total, np.concatenate(ea), np.concatenate(eb))
                    far = np.flatnonzero(label != np.arange(total))
                    ea, eb, held = [far], [label[far]], len(far)
        label = _least(total, np.concatenate(ea), np.concatenate(eb)) if ea else np.arange(total)
        nodes = np.concatenate([t.node for t in tiles]) if tiles else np.zeros(0, np.int64)
        some = np.flatnonzero(count)
        return pa.table({"node": pa.array(nodes[some], pa.int64()), "n": pa.array(count[some], pa.int64()),
                         "root": pa.array(nodes[label[some]], pa.int64())})

    return run


def _groups(spark: SparkSession, tiles: DataFrame) -> DataFrame:
    """Tiles with the number of groups their number of components needs (``_g``) and their own (``_own``).

    Enough groups that a side stays within ``SIDE_BYTES`` and every core gets some cells.
    """
    cells = CELLS_PER_CORE * parallelism(spark)
    need = tiles.where("dim > 0").groupBy("dim").agg(
        F.sum(F.length("q") + F.length("raw")).alias("b"), F.count(F.lit(1)).alias("t"))
    need = need.select(F.col("dim").alias("_dim"), F.greatest(
        F.ceil(F.col("b") / SIDE_BYTES), F.least(F.lit(math.ceil(math.sqrt(2 * cells))), F.col("t"))).cast("long").alias("_g"))
    numbered = tiles.join(need, F.col("dim") == F.col("_dim")).drop("_dim")
    return numbered.withColumn("_own", F.pmod(F.xxhash64("tile"), F.col("_g")))


def near_vectors(vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", column: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id and kept of every row: links are pairs with cosine >= ``threshold`` > 0.

    All pairs of vectors with equally many components are compared, whatever the other columns
    hold; vectors that are null, empty, zero or hold a null or non-finite component link with
    nothing.  ``n_links`` is the number of other rows linked directly; ``component_id`` the
    smallest vec_id that links reach, itself included; ``kept`` is vec_id = component_id.  Equal
    rows and rows with one id are rows of their own, so all copies of the smallest id are kept.  A
    null id counts as larger than any other: its component_id is null only where a component holds
    nothing else, and those rows are kept.  An empty table gives an empty result.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must be above 0 and at most 1")
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(column).alias("x"))
    number = F.monotonically_increasing_id()  # partition and place, packed closer
    tiles = materialize(rows.mapInArrow(_pack, _TILES).withColumn("tile", number), "tiles").withColumn(
        "tile", F.shiftleft(F.shiftright("tile", 33), 20) + F.col("tile").bitwiseAND((1 << 33) - 1))
    dealt = _groups(spark, tiles)
    cells = dealt.withColumn("_to", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_g") - 1))).select(
        "dim", F.least("_own", "_to").alias("a"), F.greatest("_own", "_to").alias("b"),
        (F.col("_own") > F.col("_to")).cast("int").alias("side"), "tile", "n", "q", "scale", "err", "raw")
    # an explicit number of partitions is kept by adaptive execution: cells are small but slow
    cells = cells.repartition(CELLS_PER_CORE * parallelism(spark), "dim", "a", "b")
    found = materialize(cells.groupBy("dim", "a", "b").applyInArrow(_cell(float(threshold)), "node long, n long, root long"), "found")
    reach = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("node").agg(F.sum("n").alias("n"))
    ids = tiles.select("tile", F.posexplode("ids").alias("_p", "id")).select(
        (F.col("tile") * TILE + F.col("_p")).alias("node"), F.col("id").alias("vec_id"))
    member = materialize(ids.join(reach, "node", "left").join(links, "node", "left"), "members")
    least = member.where("root is not null").groupBy(F.col("root").alias("r")).agg(F.min("vec_id").alias("_least")).withColumnRenamed("r", "root")
    out = attach(member, least, ["root"])
    cid = F.when(F.col("root").isNull(), F.col("vec_id")).otherwise(F.col("_least"))
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), cid.alias("component_id"),
                      F.col("vec_id").eqNullSafe(cid).alias("kept"))
