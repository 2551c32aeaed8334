"""Connected components of an edge list, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regalign.llm.common import attach, materialize

FILE_ROWS = 100_000  # edges a file should hold at least


def _fingerprint(edges: DataFrame) -> tuple:
    """Row count and an order-free digest of the edges: equal for two rounds only if nothing moved."""
    digest = F.xxhash64("hi", "lo").cast("decimal(20,0)")
    return tuple(edges.agg(F.count(F.lit(1)).alias("n"), F.sum(digest).alias("d")).first())


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node with a link; ``root`` is the smallest node it reaches.

    ``edges`` has two columns ``a`` and ``b`` of one orderable type.  Each round links every
    node's larger neighbours to its smallest one, then its smaller neighbours and itself to the
    smallest (large star, small star), until no edge moves: O(log n) rounds in practice.  Minima
    are partial aggregates; they are broadcast while the list is small, so its edges are not
    shuffled to meet them, and else joined by equi-joins that AQE splits at a hub.  The edges of a
    round are written to the shared folder, in no more files than their number asks for, so no
    lineage grows and nothing but a count and a digest reaches the driver.  Self loops are
    dropped; an empty list gives no rows.
    """
    e = edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    e = materialize(e, "edges")
    seen = _fingerprint(e)
    cores = edges.sparkSession.sparkContext.defaultParallelism
    for _ in range(max_rounds):
        if seen[0] == 0:
            break
        nodes = 2 * seen[0]  # rows of a table of minima, at most; a round makes no more edges than nodes
        both = e.select(F.explode(F.array(
            F.struct(F.col("hi").alias("u"), F.col("lo").alias("v")),
            F.struct(F.col("lo").alias("u"), F.col("hi").alias("v")))).alias("x")).select("x.u", "x.v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = attach(both.where(F.col("v") > F.col("u")), least, ["u"], "inner", salts=1, rows=nodes).select(
            F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        small = attach(large, large.groupBy("hi").agg(F.min("lo").alias("m")), ["hi"], "inner", salts=1, rows=nodes)
        moved = small.select("m", F.explode(F.array("hi", "lo")).alias("hi")).where(F.col("hi") != F.col("m")).select(
            "hi", F.col("m").alias("lo")).distinct()
        e = materialize(moved.coalesce(max(cores, nodes // FILE_ROWS)), "edges")
        now = _fingerprint(e)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(
        e.select(F.col("lo").alias("node"), F.col("lo").alias("root"))).distinct()
