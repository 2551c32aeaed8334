"""balanced_join equals the plain inner join, however small the pair budget."""

import random

from pyspark.sql import functions as F

from regalign.operators import matching as M
from regalign.operators.joins import balanced_join, hot_key_grid, key_work

TS = "2024-01-01 00:00:00"


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_balanced_join_equals_plain_join(spark):
    rng = random.Random(5)
    # one hot key holding most rows on both sides, duplicates, and null keys
    left = [("hot" if rng.random() < 0.6 else f"k{rng.randint(0, 9)}", rng.randint(0, 3)) for _ in range(300)]
    left += [(None, 1), ("hot", 1), ("hot", 1)]
    right = [("hot" if rng.random() < 0.5 else f"k{rng.randint(0, 12)}", f"v{rng.randint(0, 5)}") for _ in range(200)]
    right += [(None, "x")]
    l = spark.createDataFrame(left, "k string, a int")
    r = spark.createDataFrame(right, "rk string, b string")
    plain = l.join(r, l.k == r.rk).drop("rk")
    for budget in (1, 7, 100, 10_000_000):
        got = balanced_join(l, r, ["k"], budget, right_keys=["rk"])
        assert _rows(got.select("k", "a", "b")) == _rows(plain.select("k", "a", "b")), budget
    grid = {r.k: (r._ga, r._gb) for r in hot_key_grid(key_work(l, r.withColumnRenamed("rk", "k"), ["k"]), ["k"], 100).collect()}
    assert grid["hot"][0] > 1 and grid["hot"][1] > 1


def test_candidates_and_harmonize_with_tiny_budget(sources):
    s1, s2 = sources
    lp, rp = M.prepare_left(s1), M.prepare_right(s2)
    ln, rn = M.distinct_names(lp, "l"), M.distinct_names(rp, "r")
    key = lambda df: sorted((r.l_name, r.r_name) for r in df.collect())
    assert key(M.candidate_pairs(ln, rn, 0.85, max_pairs_per_cell=1)) == key(M.candidate_pairs(ln, rn, 0.85))
    assert key(M.candidate_pairs(ln, rn, None, max_pairs_per_cell=1)) == key(M.candidate_pairs(ln, rn, None))
    matches = M.matched_names(lp, rp)
    a = M.harmonize(lp, rp, matches, ts=TS, max_pairs_per_cell=1)
    b = M.harmonize(lp, rp, matches, ts=TS)
    assert _rows(a) == _rows(b) and a.count() == 13


def test_hot_name_pairs_spread(spark):
    left = spark.createDataFrame([("Acme Inc", f"{i} St, T, ST", None, None) for i in range(60)],
                                 "corporate_name_s1 string, address string, activity_places string, top_suppliers string")
    right = spark.createDataFrame([("ACME Corp", f"c{i}", i, i) for i in range(50)],
                                  "corporate_name_s2 string, main_customers string, revenue long, profit long")
    lp, rp = M.prepare_left(left), M.prepare_right(right)
    matches = M.matched_names(lp, rp)
    out = M.harmonize(lp, rp, matches, ts=TS, max_pairs_per_cell=100, part="matched")
    assert out.count() == 3000
    # tiny data would be broadcast and coalesced into one partition by AQE; switch both off
    # to see the grid at work in a shuffle join (the large-data case)
    confs = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(sizes) > 4 and max(sizes) < 3000


def test_cluster_sized_budget_is_exact_and_splits_the_hot_key(spark):
    from regalign.operators.joins import MIN_CELL_PAIRS, pair_budget

    rng = random.Random(9)
    left = [("hot" if rng.random() < 0.7 else f"k{rng.randint(0, 5)}", i) for i in range(400)]
    right = [("hot" if rng.random() < 0.7 else f"k{rng.randint(0, 5)}", -i) for i in range(300)]
    l = spark.createDataFrame(left, "k string, a int")
    r = spark.createDataFrame(right, "k string, b int")
    plain = l.join(r, "k")
    work = key_work(l, r, ["k"])
    total = plain.count()
    # about 4 x 8 cells for this total, never below the floor nor above the cap
    assert pair_budget(work, 10_000_000, 32) == max(MIN_CELL_PAIRS, -(-total // 32))
    assert pair_budget(work, 50, 32) == 50
    got = balanced_join(l, r, ["k"], 10_000_000, num_partitions=4, cells_per_partition=8)
    assert _rows(got.select("k", "a", "b")) == _rows(plain.select("k", "a", "b"))
    assert got.rdd.getNumPartitions() == 4


def test_grid_makes_up_a_clipped_side_on_the_other(spark):
    l = spark.range(0, 1_000_000).select(F.lit("hot").alias("k"), F.col("id").alias("a"))
    r = spark.createDataFrame([("hot", 1)], "k string, b int")
    for x, y in ((l, r), (r, l)):
        g = hot_key_grid(key_work(x, y, ["k"]), ["k"], 100).first()
        n, m = x.count(), y.count()
        assert g._ga <= n and g._gb <= m and (n / g._ga) * (m / g._gb) <= 100


def test_equal_rows_with_row_ids_spread_over_cells(spark):
    rows = spark.createDataFrame([("hot", "same")] * 400, "k string, v string")
    l = M.with_row_id(rows, "l")
    r = M.with_row_id(rows.withColumnRenamed("v", "w"), "r").withColumnRenamed(M.ROW_ID, "_rr")
    out = balanced_join(l, r, ["k"], 1000, num_partitions=16)
    assert out.count() == 160_000
    grid = hot_key_grid(key_work(l, r, ["k"]), ["k"], 1000).first()
    cells = l.groupBy(F.pmod(F.xxhash64(*[F.col(c) for c in l.columns]), F.lit(grid._ga))).count().collect()
    assert len(cells) > grid._ga / 2 and max(c["count"] for c in cells) < 4 * 400 / grid._ga + 8


def test_equal_sort_keys_spread_over_ranges(spark):
    from regalign.operators.ranking import row_number_global

    same = M.with_row_id(spark.range(4000).select(F.lit(None).cast("string").alias("k")), "same")
    ranked = row_number_global(same, ["k", M.ROW_ID], "rn", num_partitions=8)
    sizes = [r["count"] for r in ranked.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) <= 2 * 4000 / 8 and ranked.agg(F.count_distinct("rn")).first()[0] == 4000
