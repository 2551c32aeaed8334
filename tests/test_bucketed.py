"""MERGE on bucketed tables: rows, statistics, and a target that isn't shuffled."""

import re
import uuid

import pytest
from pyspark.sql import functions as F

from regalign.operators import bucketed as B
from regalign.operators import upsert


def _name():
    return "t_" + uuid.uuid4().hex


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_same_rows_as_the_plain_merge(spark):
    target = spark.range(0, 2000).select(F.col("id").cast("int").alias("id"), (F.col("id") * 2).alias("v"), F.lit("old").alias("held"))
    source = spark.range(1500, 3000).select("id", (-F.col("id")).alias("v"), F.lit(True).alias("fresh"))  # the key is a long here
    old, new = _name(), _name()
    B.write_bucketed(target, old, "id", 6)
    out, stats = B.merge_bucketed(spark, old, source, "id", new, ts="2024-01-01 00:00:00")
    want = upsert.merge_upsert(target, source.withColumn("id", F.col("id").cast("int")), "id", ts="2024-01-01 00:00:00")
    assert out.columns == want.columns and _rows(out) == _rows(want)
    assert stats == {"before_rows": 2000, "source_rows": 1500, "inserted_keys": 1000, "updated_keys": 500, "unchanged_rows": 1500,
                     "after_rows": 3000}
    assert stats == upsert.merge_stats(target, source, "id").first().asDict()
    # the new version is bucketed alike, one file a bucket, and can be merged into again
    assert B.bucket_count(spark, new) == 6 and len(out.inputFiles()) == 6
    again, _ = B.merge_bucketed(spark, new, source.limit(0).drop("fresh"), "id", _name())
    assert _rows(again) == _rows(out)


def test_no_exchange_on_the_target_side(spark):
    table = _name()
    target = B.write_bucketed(spark.range(0, 5000).withColumn("v", F.lit(1)), table, "id", 8)
    plan = B.merged(target, spark.range(10).withColumn("v", F.lit(2)), "id", 8)._jdf.queryExecution().executedPlan().toString()
    join = plan.index("SortMergeJoin")
    left, right = plan[join:].split("FileScan", 1)
    assert "Exchange" not in left and "Bucketed: true" in right.split("Exchange")[0]
    assert len(re.findall("Exchange", plan)) == 1  # the source's


def test_null_keys_and_an_empty_side(spark):
    schema = "id string, v long"
    table = _name()
    B.write_bucketed(spark.createDataFrame([("a", 1), (None, 2)], schema), table, "id", 3)
    out, stats = B.merge_bucketed(spark, table, spark.createDataFrame([(None, 3), (None, 4), ("a", 5)], schema), "id", _name(), stamp_col=None)
    assert _rows(out) == _rows(spark.createDataFrame([("a", 5), (None, 2), (None, 3), (None, 4)], schema)) and stats["updated_keys"] == 1
    none = _name()
    B.write_bucketed(spark.createDataFrame([], schema), none, "id", 3)
    assert B.merge_bucketed(spark, none, spark.createDataFrame([("x", 1)], schema), "id", _name(), stamp_col=None)[0].count() == 1


def test_cardinality_rule_stores_nothing(spark):
    table, new = _name(), _name()
    B.write_bucketed(spark.createDataFrame([("a", 1)], "id string, v long"), table, "id", 2)
    twice = spark.createDataFrame([("a", 2), ("a", 3)], "id string, v long")
    with pytest.raises(ValueError, match="more than one source row"):
        B.merge_bucketed(spark, table, twice, "id", new)
    assert not spark.catalog.tableExists(new)
    with pytest.raises(ValueError, match="not bucketed"):
        spark.range(3).write.format("parquet").option("path", B.scratch_path(spark, "flat")).saveAsTable(f"{table}_flat")
        B.bucket_count(spark, f"{table}_flat")
