"""Global row_number / dense_rank without a single-partition window.

``Window.orderBy(...)`` with no ``partitionBy`` moves every row into one task.  Here the
rows are range-partitioned on the sort key (Spark samples the key to balance the
ranges, so one hot prefix cannot pin a third of the data on one task), numbered inside
each partition in sort order, and shifted by the row count of all earlier partitions.
The offset table has one row per partition, so broadcasting it is bounded by the
partition count, not by the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regalign.session import materialize

_LOCAL_BITS = 33  # monotonically_increasing_id = partition index << 33 | position in partition


def _sort_cols(order: list[str | Column]) -> list[Column]:
    return [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order]


def row_number_global(
    df: DataFrame,
    order: list[str | Column],
    out: str = "row_number",
    num_partitions: int | None = None,
    checkpoint: bool = True,
    base: DataFrame | None = None,
) -> DataFrame:
    """``row_number() OVER (ORDER BY order)`` (ascending, nulls first) as a distributed plan.

    Give a sort key that is unique per row for a deterministic numbering.  The numbered
    frame is written once (Parquet in the cluster's shared folder) so that the partition-local
    positions are fixed and both uses of them agree; counting them reads that one column.

    ``base``: optional one-row frame with a long column ``base``; numbering then starts at
    ``base + 1``.  It enters the prefix sum as a leading pseudo-partition.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = _sort_cols(order)
    ranged = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    mid = F.monotonically_increasing_id()
    numbered = ranged.withColumn("_rg_mid", mid)
    if checkpoint:
        numbered = materialize(numbered, "numbered")
    numbered = numbered.withColumn("_rg_pid", F.shiftright("_rg_mid", _LOCAL_BITS)).withColumn(
        "_rg_pos", F.col("_rg_mid").bitwiseAND((1 << _LOCAL_BITS) - 1)
    )
    counts = numbered.groupBy("_rg_pid").agg(F.count(F.lit(1)).alias("_rg_n"))
    if base is not None:
        counts = counts.unionByName(base.select(F.lit(-1).cast("long").alias("_rg_pid"),
                                                F.col("base").cast("long").alias("_rg_n")))
    before = Window.orderBy("_rg_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_rg_pid", F.coalesce(F.sum("_rg_n").over(before), F.lit(0)).alias("_rg_off"))
    # at most `n` rows: one per range partition
    return (
        numbered.join(F.broadcast(offsets), "_rg_pid")
        .withColumn(out, F.col("_rg_off") + F.col("_rg_pos") + F.lit(1))
        .drop("_rg_mid", "_rg_pid", "_rg_pos", "_rg_off")
    )


def dense_rank_global(
    df: DataFrame,
    keys: list[str],
    out: str = "dense_rank",
    num_partitions: int | None = None,
    keys_are_distinct: bool = False,
) -> DataFrame:
    """``dense_rank() OVER (ORDER BY keys)``: rank the distinct keys, then join back.

    The distinct step is a partial + final hash aggregate; the join back is an equi-join
    on the keys (null-safe), which AQE can split when one key is hot.  When ``df`` already
    is the distinct keys, the ranked (checkpointed) keys are the answer and no join is made.
    """
    distinct_keys = df.select(*keys) if keys_are_distinct else df.select(*keys).distinct()
    ranked = row_number_global(distinct_keys, list(keys), out, num_partitions)
    if keys_are_distinct:
        return ranked
    ranked = ranked.select(*[F.col(k).alias(f"_dr_{k}") for k in keys], out)
    cond = None
    for k in keys:
        c = df[k].eqNullSafe(ranked[f"_dr_{k}"])
        cond = c if cond is None else cond & c
    return df.join(ranked, cond, "inner").drop(*[f"_dr_{k}" for k in keys])


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in ``order`` (null keys are a key).

    ``row_number() = 1`` is planned with a window group limit: every task keeps only its own first
    row of a key before the shuffle, so a hot key is one row per task.  Give an order that tells
    unequal rows apart.
    """
    at = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*order)
    return df.withColumn("_first", F.row_number().over(at)).where(F.col("_first") == 1).drop("_first")


def prefix_sums_global(df: DataFrame, order: str, values: list[str], num_partitions: int | None = None) -> DataFrame:
    """For each row, the sums of ``values`` over all rows strictly before it by ``order``, a number that is
    unique per row and not null.

    Adds ``<value>_before`` columns.  Rows are dealt into buckets of like size by cut points (quantiles
    of ``order``, one number per bucket); the bucket is the shuffle key, so the window inside a bucket
    needs no other exchange.  The totals of earlier buckets, one row per bucket, are broadcast.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # accuracy costs memory per task, not rows: buckets may be off by a part of their size
    cuts = sorted(set(df.approxQuantile(order, [i / n for i in range(1, n)], 0.1 / n)))
    dealt = df.withColumn("_bucket", _bucket(F.col(order).cast("double"), cuts)).repartition(n, "_bucket")
    inside = Window.partitionBy("_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    local = dealt.select("*", *[F.coalesce(F.sum(v).over(inside), F.lit(0)).alias(f"_in_{v}") for v in values])
    totals = dealt.groupBy("_bucket").agg(*[F.sum(v).alias(f"_t_{v}") for v in values])
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_bucket", *[F.coalesce(F.sum(f"_t_{v}").over(before), F.lit(0)).alias(f"_off_{v}") for v in values])
    out = local.join(F.broadcast(offsets), "_bucket")  # one row per bucket
    for v in values:
        out = out.withColumn(f"{v}_before", F.col(f"_off_{v}") + F.col(f"_in_{v}"))
    return out.drop("_bucket", *[f"_in_{v}" for v in values], *[f"_off_{v}" for v in values])


def _bucket(value: Column, cuts: list[float]) -> Column:
    """Number of cut points below ``value``, by binary search in nested conditions."""
    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(value <= F.lit(cuts[mid]), search(lo, mid)).otherwise(search(mid + 1, hi))

    return search(0, len(cuts))
