"""Plan-shape guards: the scale properties the design relies on."""

import math
import os

import pytest
from pyspark.sql import functions as F

from regalign.operators import matching as M
from regalign.plans.catalog import _Match
from regalign.plans import views as V

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def _plan(df):
    df.write.format("noop").mode("overwrite").save()  # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cartesian_or_nested_loop_joins(spark):
    m = _Match(spark, SF)
    for df in (m.candidates(), m.matches(), m.harmonized(), m.harmonized(collapsed=True)):
        plan = _plan(df)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_candidate_join_uses_block_and_length_class(spark):
    m = _Match(spark, SF)
    plan = _plan(m.candidates())
    assert "l_block" in plan and "_l_len" in plan
    # a name is copied to a few length classes, not to every length it may match
    import re

    rows = M.candidate_pairs(m.ln, m.rn, 0.85)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall("Generate explode", rows)) >= 2
    f = M.length_factor(0.85)
    classes = [math.floor(math.log(n * f) / math.log(f)) - math.floor(math.log(n / f) / math.log(f)) + 1 for n in range(4, 60)]
    assert max(classes) <= 4


def test_name_queries_write_no_rows_and_read_only_names(spark):
    m = _Match(spark, SF)
    plan = m.ln._jdf.queryExecution().analyzed().toString()
    assert "address" not in plan and "sides" not in m.__dict__
    m.harmonized()
    assert "city" not in m.left.columns


def test_unmatched_is_an_anti_join_on_the_names(spark):
    m = _Match(spark, SF)
    plan = M.unmatched_left(m.left, m.matches().select("l_name").distinct())._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftAnti") == 1 and "normalized_name" in plan.split("LeftAnti")[1].splitlines()[0]


def test_pairs_below_the_threshold_stay_in_the_kernel(spark):
    import pyarrow as pa

    from regalign.functions.similarity import _kernel

    text = pa.array(["abcdefgh", "abcdefgh"])
    other = pa.array(["abcdefgx", "zyxwvuts"])
    n = pa.array([8, 8], pa.int32())
    cols = {"_a": text, "_b": other, "_sa": text, "_sb": other, "_ca": text, "_cb": other}
    sizes = {f"_l{t}{x}": n for t in "rsc" for x in "xy"}
    batch = pa.RecordBatch.from_pydict({**cols, **sizes, "_li": pa.array([0, 0], pa.int32())})
    out = next(_kernel(0.85, (0.3, 0.4, 0.3))(iter([batch])))
    assert out.num_rows == 1 and out.column("_lcs_set").to_pylist() == [7]
    assert next(_kernel(None, (0.3, 0.4, 0.3))(iter([batch]))).num_rows == 2


def test_scoring_is_spread_over_partitions(spark):
    matched = _Match(spark, SF).matches()
    parts = matched.select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts > 1


def test_scans_are_pruned(spark):
    plan = _plan(V.supply_view(spark, SF).select("row_id", "corporate_name_s1"))
    assert "p_retailprice" not in plan  # only the columns used are read
    q = V.table(spark, SF, "orders").where(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz"))
    assert "PushedFilters: [IsNotNull(o_orderdate), LessThan(o_orderdate" in q._jdf.queryExecution().executedPlan().toString() \
        or "LessThan(o_orderdate" in _plan(q)


def test_ranking_is_not_single_task(spark):
    from regalign.operators.ranking import row_number_global

    df = spark.range(0, 5000).select((F.col("id") % 97).cast("string").alias("k"), F.col("id"))
    ranked = row_number_global(df, ["k", "id"], "rn", num_partitions=4)
    per_part = ranked.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(per_part) > 1 and max(r["count"] for r in per_part) < 5000
    assert ranked.agg(F.min("rn"), F.max("rn"), F.count_distinct("rn")).first()[:] == (1, 5000, 5000)


def test_pairs_are_scored_where_they_are_made(spark):
    # the name tables are shuffled by (key, cell); the candidate pairs, the largest
    # intermediate, reach the Arrow scorer without another exchange
    lines = _plan(_Match(spark, SF).matches()).splitlines()
    start = next(i for i, s in enumerate(lines) if "MapInArrow" in s)
    below = []
    for s in lines[start + 1:]:
        if "Join" in s:
            break
        below.append(s)
    assert not any(w in s for s in below for w in ("Exchange", "ShuffleQueryStage", "AQEShuffleRead"))
