"""Int8 tile products against brute force in double precision; the bounds; the shape of the output."""

import random

import numpy as np
import pytest

from regalign.llm import int8_tiles as I

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold=0.9):
    def ok(x):
        return x is not None and len(x) > 0 and all(v is not None and np.isfinite(v) for v in x) and any(v != 0 for v in x)

    n = len(rows)
    x = [np.array(r[1], dtype=np.float32).astype(float) if ok(r[1]) else None for r in rows]
    links = [[j for j in range(n) if j != i and x[i] is not None and x[j] is not None and len(x[i]) == len(x[j])
              and x[i] @ x[j] / np.linalg.norm(x[i]) / np.linalg.norm(x[j]) >= threshold] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        cid = min(ids) if ids else None
        out.append((rows[i][0], len(links[i]), cid, rows[i][0] == cid))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()), key=repr)


def vectors(seed, n, dim=16, groups=12, noise=0.3):
    """Groups around hubs with cosines on both sides of 0.9, and single vectors."""
    rng = np.random.default_rng(seed)
    hubs = rng.normal(size=(groups, dim))
    rows = []
    for i in range(n):
        v = hubs[i % groups] + noise * rng.normal(size=dim) if i % 3 else rng.normal(size=dim)
        rows.append((int(rng.integers(0, 10**6)), (v * 10.0 ** rng.integers(-3, 4)).astype(np.float32).tolist(), i % 5))
    return rows


def test_against_brute_force(spark, write):
    rows = vectors(1, 400)
    rows += [(1, None, 0), (2, [], 0), (3, [0.0] * 16, 0), (4, [None] + [1.0] * 15, 0), (5, [float("nan")] * 16, 0),
             (6, [float("inf")] + [1.0] * 15, 0), (7, [1.0] * 15, 0), (8, [2.0] * 15, 0), (9, [1e-30] * 16, 0), (10, [1e30] * 16, 0),
             (None, [1.0] * 16, 0), (None, [-1.0] * 16, None), (None, [-2.0] * 16, None), (None, None, None), rows[0], rows[0], (rows[1][0], rows[4][1], 0)]
    assert got(I.near_vectors(write(rows, SCHEMA))) == brute(rows)


def test_small_tiles_meet_in_every_cell(spark, write, monkeypatch):
    rows = vectors(2, 300, noise=0.25)
    monkeypatch.setattr(I, "TILE", 16)
    assert got(I.near_vectors(write(rows, SCHEMA))) == brute(rows)
    monkeypatch.setattr(I, "SIDE_BYTES", 4000)  # many more cells than cores
    assert got(I.near_vectors(write(rows, SCHEMA), threshold=0.8)) == brute(rows, 0.8)


@pytest.mark.parametrize("n", [0, 1, 2])
def test_few_rows_and_clashing_columns(spark, write, n):
    rows = [(i, [1.0, 2.0], 0, "a", "b") for i in range(n)]
    df = write(rows, SCHEMA + ", node string, tile string") if n else spark.createDataFrame([], SCHEMA + ", node string, tile string")
    assert got(I.near_vectors(df)) == brute([r[:3] for r in rows])


def test_a_large_group_of_copies_gives_one_row_each(spark, write):
    rng = random.Random(3)
    hub = [rng.gauss(0, 1) for _ in range(32)]
    rows = [(i, hub if i % 2 else [v + rng.gauss(0, 0.01) for v in hub], 0) for i in range(3000)] + [(9000, [-v for v in hub], 0)]
    out = I.near_vectors(write(rows, SCHEMA)).collect()
    assert {(r.n_links, r.component_id) for r in out if r.vec_id < 3000} == {(2999, 0)} and len(out) == 3001
    assert sum(r.kept for r in out) == 2


def test_doubles_keep_their_precision(spark):
    # the two differ from 0.9 by less than single precision tells
    base = np.zeros(4)
    base[0] = 1.0
    rows = [(i, [c, (1 - c * c) ** 0.5, 0.0, 0.0]) for i, c in ((1, 0.9 + 1e-10), (2, 0.9 - 1e-10))] + [(0, base.tolist())]
    out = {r.vec_id: r.n_links for r in I.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert out == {0: 1, 1: 2, 2: 1}


def _tile(x, number=0):
    q, scale, err = I.quantise(I.unit(x))
    return I._Tile(number, x.shape[1], len(x), q.tobytes(), scale.tobytes(), err.tobytes(), x.tobytes())


@pytest.mark.parametrize("dim", [1, 3, 64, 1500])
def test_the_bound_holds_and_few_pairs_are_worked_out_again(dim):
    rng = np.random.default_rng(dim)
    x, y = rng.normal(size=(200, dim)), rng.normal(size=(150, dim)) * rng.exponential(size=dim)
    y[:80] = x[:80] + 0.4 * rng.normal(size=(80, dim))
    a, b = _tile(x), _tile(y)
    true = I.unit(x) @ I.unit(y).T
    approx = (a.q.astype(float) @ b.q.T) * a.scale[:, None] * b.scale
    assert (np.abs(true - approx) <= a.err[:, None] * (1 + b.err) + b.err).all()
    stats = {}
    hits = I.linked(a, b, 0.9, stats)
    assert (hits == (true >= 0.9)).all() and stats["pairs"] == 30000
    assert dim < 64 or stats["again"] < 100


def test_spanning_links_connect_what_the_links_connect():
    rng = np.random.default_rng(5)
    for share in (0.001, 0.02, 0.05, 0.5, 1.0):
        hits = rng.random((60, 40)) < share
        hits[:30, 20:] = False
        a, b = I._spanning(hits)
        assert hits[a, b].all()
        i, j = np.nonzero(hits)
        assert (I._least(100, a, b + 60) == I._least(100, i, j + 60)).all()
        assert len(a) <= 4 * 100
