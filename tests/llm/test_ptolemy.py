"""Centroid clustering against brute-force Lloyd rounds; the bounds against exact distances."""

import hashlib
import random

import numpy as np
import pytest

from regalign.llm import ptolemy

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=16, rounds=3, dim=64, scale=64):
    """Plain Lloyd rounds on Python integers."""
    def key(r):
        return ((1, "") if r[0] is None else (0, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest()), r[1])

    kept = [r for r in rows if r[1] is not None and len(r[1]) == dim and all(x is not None and abs(x) < 2**27 / scale for x in r[1])]
    ints = [[int(np.floor(scale * float(np.float32(x)))) for x in r[1]] for r in kept]
    order = sorted(range(len(kept)), key=lambda i: (key(kept[i])[0], ints[i]))[:k]
    cents = [ints[i] for i in order]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents)) for v in ints]

    for _ in range(rounds):
        where = assign()
        for j in range(len(cents)):
            own = [v for v, (_, n) in zip(ints, where) if n == j]
            if own:
                cents[j] = [sum(col) // len(own) for col in zip(*own)]
    where = assign()
    total = sum(d for d, _ in where)
    own = {j: sum(d for d, n in where if n == j) for j in range(len(cents))}
    return sorted((-1 if r[0] is None else r[0], j, d, own[j], total, hashlib.sha256(",".join(map(str, cents[j])).encode()).hexdigest())
                  for r, (d, j) in zip(kept, where))


def got(df):
    return sorted((-1 if r.vec_id is None else r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256)
                  for r in df.collect())


def vectors(seed, n, dim=64, spread=0.12, groups=0):
    rng = random.Random(seed)
    hubs = [[rng.gauss(0, 0.5) for _ in range(dim)] for _ in range(groups)]
    return [(i, [(hubs[i % groups][j] if groups else 0) + rng.gauss(0, spread) for j in range(dim)], 0) for i in range(n)]


def test_against_brute_force_with_odd_rows(spark, write):
    rows = vectors(1, 300)
    rows += [(500, None, 1), (501, [], 1), (502, [0.0] * 63, 1), (503, [None] + [0.1] * 63, 1), (504, [float("nan")] * 64, 1),
             (505, [float("inf")] + [0.0] * 63, 1), (506, [1e30] + [0.0] * 63, 1), (None, [0.2] * 64, None), (None, [0.0] * 64, 2),
             rows[3], rows[3], (rows[4][0], rows[5][1], 9), (507, [-0.01] * 64, 1), (508, [3000.0] + [0.0] * 63, 1)]
    assert got(ptolemy.cluster(write(rows, SCHEMA))) == brute(
        [r for r in rows if r[1] is None or not any(x is not None and x != x for x in r[1])])


@pytest.mark.parametrize("n", [0, 1, 7, 17])
def test_few_rows(spark, write, n):
    rows = vectors(2, n)
    out = ptolemy.cluster(write(rows, SCHEMA) if n else spark.createDataFrame([], SCHEMA))
    assert got(out) == brute(rows)


def test_ties_and_equal_rows(spark, write):
    rows = [(i, [float(i % 2)] * 64, 0) for i in range(60)]  # two vectors only: equal centroids, empty ones stay
    assert got(ptolemy.cluster(write(rows, SCHEMA))) == brute(rows)


def test_other_sizes_and_clashing_columns(spark, write):
    rows = [(*r, "c", "n", "t") for r in vectors(3, 80, dim=5)]
    df = write(rows, SCHEMA + ", cluster string, distance string, x string").withColumnRenamed("vec_id", "key")
    out = ptolemy.cluster(df, k=4, rounds=5, dim=5, id_col="key")
    assert got(out) == brute([r[:3] for r in rows], k=4, rounds=5, dim=5)
    assert got(ptolemy.cluster(df, k=4, rounds=0, dim=5, id_col="key")) == brute([r[:3] for r in rows], k=4, rounds=0, dim=5)


def test_bounds_never_exceed_the_distance():
    rng = np.random.default_rng(4)
    for size in (5, 3000, 1 << 26):
        x, first, now = (rng.integers(-size, size, (n, 64)) for n in (400, 16, 16))
        now[:4] = first[:4]
        mean = x.sum(0) // len(x)
        exact = ptolemy.squared(x, now)
        low = ptolemy.bounds(ptolemy.squared(x, mean[None])[:, 0], ptolemy.squared(x, first), mean, first, now)
        assert (low <= np.sqrt(exact.astype(float))).all() and low.max() > 0
        assert (exact == np.stack([((x - c) ** 2).sum(1) for c in now], 1)).all()


def test_the_bounds_leave_most_pairs_out(spark, write):
    rows = vectors(5, 600, groups=16, spread=0.05)
    out = ptolemy.cluster(write(rows, SCHEMA)).collect()
    checked = sum(r.checked for r in out) / len(out) / 16
    assert checked < 0.5
    unit = [(i, [c / sum(d * d for d in v) ** 0.5 for c in v], g) for i, v, g in vectors(6, 5000)]
    even = ptolemy.cluster(write(unit, SCHEMA)).collect()  # evenly spread: the hard case
    assert sum(r.checked for r in even) / len(even) / 16 < 0.85
