"""Equi-joins whose work is balanced by the number of *pairs* a key produces.

AQE splits a skewed join partition when its *input* is large.  A join that emits many
pairs per key from small inputs (a block of a million short names on each side: ~50 MB
in, 10^12 pairs out) is invisible to that rule, and one task would produce all of it.

``balanced_join`` counts rows per key on both sides (partial aggregates) and spreads every
key whose pair count n_left * n_right exceeds ``max_pairs`` over an A x B grid of cells:
a left row goes to row ``hash(left row) % A`` of the grid (give equal rows a row id to keep them apart) and is copied to its B cells, a
right row goes to column ``hash(right row) % B`` and is copied to its A cells.  Each
(left, right) pair meets in exactly one cell, so the result is the plain inner join;
each cell holds about n_left/A * n_right/B pairs, and copies grow only with sqrt(pairs).
Keys under the budget take A = B = 1 (no copies).  The table of hot keys is joined
without a broadcast hint, so AQE broadcasts it only when it is small at run time.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_PAIRS = 20_000_000
MIN_CELL_PAIRS = 1_000


def key_work(left: DataFrame, right: DataFrame, keys: list[str], left_counts: DataFrame | None = None,
             right_counts: DataFrame | None = None) -> DataFrame:
    """Per key on both sides: rows of either (``_nl``, ``_nr``) and pairs (``_w``).

    ``left_counts`` / ``right_counts`` (keys + ``_nl`` / ``_nr``) may be given when the
    caller already has them from an earlier aggregate; otherwise they are counted here.
    """
    lc = left_counts if left_counts is not None else left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_nl"))
    rc = right_counts if right_counts is not None else right.groupBy(*keys).agg(F.count(F.lit(1)).alias("_nr"))
    return lc.join(rc, keys).withColumn("_w", F.col("_nl").cast("double") * F.col("_nr").cast("double"))


def hot_key_grid(work: DataFrame, keys: list[str], max_pairs: int) -> DataFrame:
    """Keys whose pair count exceeds ``max_pairs``, with grid sides ``_ga`` x ``_gb``."""
    budget = F.lit(float(max_pairs))
    # about square, but a side has at most as many cells as rows, and what one side can't be cut
    # into is made up on the other
    first = F.least(F.ceil(F.sqrt(F.col("_w") / budget)), F.col("_nr"))
    ga = F.least(F.ceil(F.col("_w") / (budget * first)), F.col("_nl"))
    gb = F.least(F.ceil(F.col("_w") / (budget * ga)), F.col("_nr"))
    return work.where(F.col("_w") > budget).select(*keys, ga.cast("int").alias("_ga"), gb.cast("int").alias("_gb"))


def pair_budget(work: DataFrame, max_pairs: int, target_cells: int, min_pairs: int = MIN_CELL_PAIRS) -> int:
    """Pairs per grid cell so the join makes about ``target_cells`` cells, at least
    ``min_pairs`` and never above the caller's cap ``max_pairs``.  The total comes back
    as one number from an aggregate over the per-key count table (one row per key,
    never the rows themselves).
    """
    total = work.agg(F.sum("_w").alias("w")).first()["w"] or 0.0
    return int(min(max_pairs, max(min_pairs, math.ceil(total / max(1, target_cells)))))


def balanced_join(left: DataFrame, right: DataFrame, keys: list[str], max_pairs: int = DEFAULT_MAX_PAIRS,
                  right_keys: list[str] | None = None, left_counts: DataFrame | None = None,
                  right_counts: DataFrame | None = None, num_partitions: int | None = None,
                  cells_per_partition: int | None = None) -> DataFrame:
    """Inner equi-join ``left.keys == right.right_keys`` with hot keys split into grid cells.

    Returns the columns of ``left`` then ``right`` (right key columns renamed to the left
    names are dropped), exactly the rows of the plain inner join.  Precomputed per-key
    counts (named with the left key names) avoid a second pass over large inputs.

    ``num_partitions``: hash-partition both inputs on (keys, cell) into exactly this many
    partitions before joining.  The join then needs no other exchange and its output stays
    spread over that many tasks (an explicit count is not coalesced by AQE), so CPU-heavy
    work on the pairs can follow in the same stage without shuffling the pairs.

    ``cells_per_partition`` (with ``num_partitions``): size the cells to the cluster instead
    of the fixed ``max_pairs``: the budget becomes total pairs / (partitions x this), capped
    by ``max_pairs``, so there are several cells per task and the pair work evens out.
    """
    rkeys = right_keys or keys
    r = right
    for lk, rk in zip(keys, rkeys):
        if lk != rk:
            r = r.withColumnRenamed(rk, lk)
    work = key_work(left, r, keys, left_counts, right_counts)
    if num_partitions and cells_per_partition:
        max_pairs = pair_budget(work, max_pairs, num_partitions * cells_per_partition)
    grid = hot_key_grid(work, keys, max_pairs)
    one = F.lit(1)
    lg = left.join(grid, keys, "left")
    lg = lg.withColumn("_ga", F.coalesce("_ga", one)).withColumn("_gb", F.coalesce("_gb", one))
    lg = lg.withColumn("_ca", F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]), F.col("_ga")))
    lg = lg.withColumn("_cb", F.explode(F.sequence(F.lit(0), F.col("_gb") - 1))).drop("_ga", "_gb")
    rg = r.join(grid, keys, "left")
    rg = rg.withColumn("_ga", F.coalesce("_ga", one)).withColumn("_gb", F.coalesce("_gb", one))
    rg = rg.withColumn("_cb", F.pmod(F.xxhash64(*[F.col(c) for c in r.columns]), F.col("_gb")))
    rg = rg.withColumn("_ca", F.explode(F.sequence(F.lit(0), F.col("_ga") - 1))).drop("_ga", "_gb")
    on = keys + ["_ca", "_cb"]
    if num_partitions:
        lg = lg.repartition(num_partitions, *on)
        rg = rg.repartition(num_partitions, *on)
    return lg.join(rg, on, "inner").drop("_ca", "_cb")
