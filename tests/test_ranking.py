"""First rows per key and prefix sums: results against brute force, and the plans they rely on."""

import random

import pytest
from pyspark.sql import functions as F

from regalign.operators import learn, matching as M, upsert
from regalign.operators.ranking import first_per_key, prefix_sums_global


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_per_key_against_brute_force(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, "hot", "hot", "hot", "a", "b"]), rng.choice([None, 1, 2, 3]), rng.choice([None, "x", "y"])) for _ in range(500)]
    df = spark.createDataFrame(rows, "k string, v int, s string").repartition(7)
    got = {r.k: (r.v, r.s) for r in first_per_key(df, ["k"], [F.col("v").desc_nulls_last(), F.col("s").asc_nulls_first()]).collect()}
    want = {}
    for k, v, s in rows:
        rank = (-(v if v is not None else -1), s is not None, s or "")
        want[k] = min(want.get(k, (rank, v, s)), (rank, v, s), key=lambda t: t[0])
    assert got == {k: t[1:] for k, t in want.items()}


def test_reductions_per_key_keep_one_row_per_task_before_the_shuffle(spark, harmonised_frame, log):
    for df in (M.collapse_by_id(harmonised_frame), upsert.read_current(log, "id"), upsert.as_of(log, "id", version=2),
               upsert.expire(log, "id", "2024-01-02 12:00:00")):
        plan = _plan(df)
        assert "SortAggregate" not in plan and "WindowGroupLimit" in plan
        # the partial limit stands below the exchange by key
        assert "Partial" in plan.split("Exchange hashpartitioning", 1)[1]


@pytest.fixture()
def harmonised_frame(spark):
    return spark.createDataFrame([], ", ".join(f"{c} string" if c not in ("revenue", "profit", "similarity_score") else f"{c} double"
                                               for c in M.HARMONISED))


@pytest.fixture()
def log(spark):
    c = upsert.append_changes(None, spark.createDataFrame([("a", 1), ("b", 2)], "id string, v long"), 1, "2024-01-01 00:00:00")
    return upsert.append_changes(c, spark.createDataFrame([("b", 20)], "id string, v long"), 2, "2024-01-02 00:00:00")


@pytest.mark.parametrize("n", [0, 1, 5, 700])
def test_prefix_sums_against_brute_force(spark, n):
    rng = random.Random(n)
    order = rng.sample(range(-5000, 5000), n)
    rows = [(x / 7, rng.randint(0, 9), None if rng.random() < 0.1 else rng.randint(-5, 5)) for x in order]
    df = spark.createDataFrame(rows, "s double, a long, b long").repartition(5)
    got = {r.s: (r.a_before, r.b_before) for r in prefix_sums_global(df, "s", ["a", "b"], num_partitions=6).collect()}
    want = {r[0]: (sum(x[1] for x in rows if x[0] < r[0]), sum(x[2] or 0 for x in rows if x[0] < r[0])) for r in rows}
    assert got == want


def test_auc_shuffles_scores_twice_and_sorts_nothing_globally(spark):
    rng = random.Random(3)
    rows = [(int(rng.random() < 0.3), round(rng.random(), 2)) for _ in range(400)] + [(1, 0.5)] * 300 + [(0, 0.5)] * 200
    pred = spark.createDataFrame(rows, "y int, p1 double")
    auc = learn.auc_roc(pred, "y")
    plan = _plan(auc)
    # distinct scores, then buckets; the window and the bucket totals need no other exchange
    assert plan.count("Exchange hashpartitioning") - plan.count("ReusedExchange") <= 4 and "rangepartitioning" not in plan
    window = plan[plan.index("Window"):]
    assert "hashpartitioning(_bucket" in window[:window.index("HashAggregate")]
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    want = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert auc.first().auc == pytest.approx(want, abs=1e-12)
