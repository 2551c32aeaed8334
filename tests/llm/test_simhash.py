import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
import xxhash

import regalign.llm.simhash as simhash_module
from regalign.llm.components import components
from regalign.llm.simhash import (
    Tree,
    blocks_for,
    linked,
    near_duplicates,
    near_pairs,
    one_of_each,
    simhash,
    subspaces,
)

BLANKS = " \t\n\x0b\x0c\r"


def brute_fingerprint(text, shingle=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in BLANKS:
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    grams = [" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(values, bits):
    roots = {v: v for v in values}

    def find(v):
        while roots[v] != v:
            v = roots[v]
        return v

    for a in values:
        for b in values:
            if (a ^ b).bit_count() <= bits:
                x, y = find(a), find(b)
                roots[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


def test_whole_table_against_brute_force(docs, corpus):
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in near_duplicates(docs).collect()), key=repr)
    fps = [brute_fingerprint(r[1]) for r in corpus]
    comp = brute_components(set(fps), 4)
    least = {}
    for r, f in zip(corpus, fps):
        if r[0] is not None:
            least[comp[f]] = min(least.get(comp[f], r[0]), r[0])
    assert got == sorted(((r[0], f"{f:016x}", least.get(comp[f])) for r, f in zip(corpus, fps)), key=repr)


def clusters(n=300, seed=1):
    rng = random.Random(seed)
    out = set()
    for _ in range(n):
        v = rng.getrandbits(64)
        out.add(v)
        for _ in range(rng.choice([0, 0, 1, 6])):
            v ^= sum({1 << rng.randrange(64) for _ in range(rng.randint(1, 6))})
            out.add(v)
    return sorted(out)


@pytest.mark.parametrize("blocks,leaf,cell", [(1, 40, 4096), (2, 20, 16), (3, 10, 4096), (4, 4, 4096), (4, 2, 16), (5, 8, 8), (6, 30, 4096)])
def test_trees_lose_no_link(spark, blocks, leaf, cell):
    values = clusters()
    fps = spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in values], "fp long")
    links = near_pairs(fps, 4, blocks=blocks, leaf=leaf, cell=cell, sample=150)
    pairs = [(int(np.int64(a).view(np.uint64)), int(np.int64(b).view(np.uint64))) for a, b in links.distinct().collect()]
    roots = {v: v for v in values}

    def find(v):
        while roots[v] != v:
            v = roots[v]
        return v

    for a, b in pairs:
        x, y = find(a), find(b)
        roots[max(x, y)] = min(x, y)
    assert {v: find(v) for v in values} == brute_components(values, 4)


@pytest.mark.parametrize("blocks", range(1, 9))
def test_every_spread_of_bits_is_in_some_reach(blocks):
    rng = random.Random(blocks)
    trees = subspaces(4, blocks)
    for bits in (*combinations(range(0, 64, 5), 4), *[rng.sample(range(64), 4) for _ in range(2000)]):
        diff = sum(1 << b for b in bits)
        assert any((diff & mask).bit_count() <= reach for mask, reach in trees)


def test_shapes_grow_with_the_table():
    assert [r for _, r in subspaces(4, 4)] == [1, 0, 0, 0] and len(subspaces(4, 6)) == 15
    assert [blocks_for(n, 4) for n in (0, 10**6, 10**8, 10**11)] == [4, 4, 6, 7]
    assert blocks_for(10, 0) == blocks_for(10, 1) == 1 and subspaces(0, 1) == [(2**64 - 1, 0)]


def test_pruned_trees_lose_links_without_the_visits(spark, monkeypatch):
    """What the triangle bounds send to a second leaf decides links: bits 1 apart in each of the four blocks."""
    rng = random.Random(8)
    masks = [m for m, _ in subspaces(4, 4)]
    values = []
    for _ in range(400):
        v = rng.getrandbits(64)
        values += [v, v ^ sum(1 << rng.choice([b for b in range(64) if m >> b & 1]) for m in masks)]
    fps = spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in values], "fp long")

    def pairs():
        links = near_pairs(fps, 4, leaf=4, sample=400).distinct().collect()
        return {frozenset((r.a, r.b)) for r in links}

    want = {frozenset(np.array(p, np.uint64).view(np.int64).tolist()) for p in zip(values[::2], values[1::2])}
    assert pairs() == want
    monkeypatch.setattr(Tree, "reached", lambda self, x, reach: (np.arange(len(x)), self.home(x)))
    assert 0 < len(pairs()) < len(want)


def test_deep_levels_prune_and_reach(monkeypatch):
    """Hashed vantage points below the fitted levels: no neighbour is lost and most leaves are pruned."""
    monkeypatch.setattr(simhash_module, "TABLE_DEPTH", 3)
    values = np.array(clusters(400, 5), dtype=np.uint64)
    mask, reach = subspaces(4, 4)[0]
    tree = Tree(values[::3], mask, depth=8)
    home = tree.home(values)
    row, leaf = tree.reached(values, reach)
    reached = set(zip(row.tolist(), leaf.tolist()))
    assert len(np.unique(home)) > 100 and len(row) < 30 * len(values)
    for i, v in enumerate(values):
        for j in np.flatnonzero(np.bitwise_count((values ^ v) & np.uint64(mask)) <= reach):
            assert (i, int(home[j])) in reached


def test_triangle_bounds_reach_every_leaf_that_holds_a_neighbour():
    values = np.array(clusters(200, 3), dtype=np.uint64)
    for mask, reach in subspaces(4, 2):
        tree = Tree(values[::3], mask, depth=5)
        home = tree.home(values)
        row, leaf = tree.reached(values, reach)
        reached = {(int(i), int(x)) for i, x in zip(row, leaf)}
        for i, v in enumerate(values):
            near = np.flatnonzero(np.bitwise_count((values ^ v) & np.uint64(mask)) <= reach)
            assert all((i, int(home[j])) in reached for j in near)


def test_a_dense_group_returns_a_star_not_all_pairs():
    x = np.arange(512, dtype=np.uint64)
    assert len(linked(x, 4)) == 511


def test_long_text_and_empty_table(docs, empty):
    assert simhash(b"w " * 200_000, 4) == simhash(b"w w w w", 4)
    assert near_duplicates(empty).count() == 0 and one_of_each(empty).count() == 0


def test_one_row_of_each_group_stays(wide, corpus):
    kept = one_of_each(wide)
    assert kept.columns == wide.columns
    rows = kept.collect()
    fps = [brute_fingerprint(r[1]) for r in corpus]
    comp = brute_components(set(fps), 4)
    assert sorted(comp[brute_fingerprint(r.text)] for r in rows) == sorted(set(comp.values()))
    assert all(r.kept == "kept as it is" for r in rows)
    ids = {}
    for r, f in zip(corpus, fps):
        if r[0] is not None:
            ids[comp[f]] = min(ids.get(comp[f], r[0]), r[0])
    assert {r.doc_id for r in rows} == set(ids.values())


def test_components_on_a_path_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(100)] + [(500, 500 + i) for i in range(1, 50)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(101)}, **{500 + i: 500 for i in range(50)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_small_list_of_edges_is_written_in_few_files(spark):
    """However many shuffle partitions are set: each task that writes a small table costs memory and files."""
    rng = random.Random(6)
    edges = [(rng.randrange(3000), rng.randrange(3000)) for _ in range(2500)]
    held = {"spark.sql.shuffle.partitions": "48", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        found = components(spark.createDataFrame(edges, "a long, b long"))
        files = len(found.inputFiles())
        got = {r.node: r.root for r in found.collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    roots = {v: v for e in edges for v in e}

    def find(v):
        while roots[v] != v:
            v = roots[v]
        return v

    for a, b in edges:
        x, y = find(a), find(b)
        roots[max(x, y)] = min(x, y)
    assert got == {v: find(v) for v in roots if any(v in e and e[0] != e[1] for e in edges)}
    assert files <= spark.sparkContext.defaultParallelism


def test_a_dense_group_is_routed_in_bounded_parts(spark, monkeypatch):
    """Each part of a dense group may reach every leaf; no batch that a task holds exceeds the bound."""
    monkeypatch.setattr(simhash_module, "ROUTED", 1 << 10)
    values = np.array([sum(1 << b for b in bits) for bits in combinations(range(16), 3)], dtype=np.uint64)
    tree = Tree(values, (1 << 16) - 1, depth=7)
    sizes = []
    reached = Tree.reached
    monkeypatch.setattr(Tree, "reached", lambda self, x, reach: sizes.append(len(out := reached(self, x, reach)[0])) or reached(self, x, reach))

    class Frame:  # runs the task's function here
        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            return list(run([pa.RecordBatch.from_arrays([pa.array(values.view(np.int64))], ["fp"])]))

    routed = simhash_module.route(Frame(), [(tree, 2)])
    assert max(sizes) <= 1 << 10 and max(b.num_rows for b in routed) <= 1 << 10
    monkeypatch.setattr(simhash_module, "ROUTED", 1 << 30)
    whole = simhash_module.route(Frame(), [(tree, 2)])
    pairs = [sorted((leaf, fp) for b in x for leaf, fp in zip(b.column("leaf").to_pylist(), b.column("fp").to_pylist())) for x in (routed, whole)]
    assert pairs[0] == pairs[1] and max(b.num_rows for b in whole) > 1 << 10
