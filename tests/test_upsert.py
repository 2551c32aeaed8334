"""MERGE upsert, statistics, as-of reads, snapshot log, expiry and compaction."""

import pytest
from pyspark.sql import functions as F

from regalign.operators import upsert
from regalign.session import scratch_path

SCHEMA = "id string, v long"


def test_merge_upsert_and_stats(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2)], SCHEMA)
    source = spark.createDataFrame([("b", 20), ("c", 30)], SCHEMA)
    out = {r.id: r.v for r in upsert.merge_upsert(target, source, "id", ts="2024-01-01").collect()}
    assert out == {"a": 1, "b": 20, "c": 30}
    st = upsert.merge_stats(target, source, "id").first()
    assert (st.before_rows, st.inserted_keys, st.updated_keys, st.unchanged_rows, st.after_rows) == (2, 1, 1, 1, 3)


def test_merge_into_empty_target(spark):
    target = spark.createDataFrame([], SCHEMA)
    source = spark.createDataFrame([("x", 1)], SCHEMA)
    assert upsert.merge_upsert(target, source, "id", stamp_col=None).count() == 1


def test_merge_cardinality_violation(spark):
    target = spark.createDataFrame([("a", 1)], SCHEMA)
    source = spark.createDataFrame([("a", 2), ("a", 3)], SCHEMA)
    with pytest.raises(ValueError, match="more than one source row"):
        upsert.merge_upsert(target, source, "id")
    assert upsert.merge_upsert(target, source.where("v = 2"), "id", stamp_col=None).collect()[0].v == 2


def test_merge_keeps_all_columns_and_null_keys(spark):
    target = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), (None, 3, "z")], "id string, v long, extra string")
    source = spark.createDataFrame([("b", 20, True), ("c", 30, False), (None, 40, None)], "id string, v long, flag boolean")
    out = upsert.merge_upsert(target, source, "id", stamp_col=None)
    assert out.columns == ["id", "v", "extra", "flag"]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted([
        ("a", 1, "x", None), ("b", 20, "y", True), ("c", 30, None, False), (None, 3, "z", None), (None, 40, None, None)], key=repr)


@pytest.fixture()
def changes(spark):
    c = upsert.append_changes(None, spark.createDataFrame([("a", 1), ("b", 2)], SCHEMA), 1, "2024-01-01 00:00:00")
    c = upsert.append_changes(c, spark.createDataFrame([("b", 20), ("c", 30)], SCHEMA), 2, "2024-01-02 00:00:00")
    return upsert.append_changes(c, spark.createDataFrame([("a", 100)], SCHEMA), 3, "2024-01-03 00:00:00")


def _state(df):
    return {r.id: r.v for r in df.collect()}


def test_as_of(changes):
    assert _state(upsert.as_of(changes, "id", version=1)) == {"a": 1, "b": 2}
    assert _state(upsert.as_of(changes, "id", version=2)) == {"a": 1, "b": 20, "c": 30}
    assert _state(upsert.as_of(changes, "id", timestamp="2024-01-02 12:00:00")) == {"a": 1, "b": 20, "c": 30}
    assert _state(upsert.as_of(changes, "id", version=1, timestamp="2024-01-03")) == {"a": 1, "b": 2}
    assert _state(upsert.as_of(changes, "id", version=0)) == {}
    assert _state(upsert.read_current(changes, "id")) == {"a": 100, "b": 20, "c": 30}
    with pytest.raises(ValueError, match="Either snapshot_id or timestamp"):
        upsert.as_of(changes, "id")


def test_snapshot_log_and_expire(changes):
    log = {r.snapshot_id: (r.changed_rows, r.changed_keys) for r in upsert.snapshot_log(changes, "id").collect()}
    assert log == {1: (2, 2), 2: (2, 2), 3: (1, 1)}
    kept = upsert.expire(changes, "id", "2024-01-02 12:00:00")
    assert kept.count() == 4  # a@1, b@2, c@2 folded + a@3
    for v in (2, 3):
        assert _state(upsert.as_of(kept, "id", version=v)) == _state(upsert.as_of(changes, "id", version=v))


def test_compact(spark):
    df = spark.range(0, 1000).select(F.col("id").cast("string").alias("id"), F.col("id").alias("v"))
    plain = scratch_path(spark, "compact-in")
    df.repartition(20).write.parquet(plain)
    src = spark.read.parquet(plain)
    n = upsert.file_count(src, 8_000)
    path = upsert.compact(src, scratch_path(spark, "compact-test"), "v", target_bytes=8_000)
    back = spark.read.parquet(path)
    assert back.count() == 1000 and 1 < len(back.inputFiles()) <= n < 20
    assert upsert.file_count(src) == 1


def test_merge_through_sql(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2)], SCHEMA)
    source = spark.createDataFrame([("b", 20), ("c", 30)], SCHEMA)
    t = upsert.register_updates(target, "merge_target_t")
    s = upsert.register_updates(source.select("v", "id"), "harmonized_updates")  # another column order
    out = {r.id: r.v for r in spark.sql(upsert.merge_sql(t, s, "id", ["id", "v"])).collect()}
    assert out == {"a": 1, "b": 20, "c": 30}


def test_merge_through_sql_stamps_and_checks(spark):
    target = spark.createDataFrame([("a", 1, None), ("b", 2, None), (None, 3, None)], "id string, v long, last_updated timestamp")
    t = upsert.register_updates(target, "stamped_target")
    s = upsert.register_updates(spark.createDataFrame([("b", 20), ("c", 30), ("c", 31), (None, 40)], SCHEMA), "harmonized_updates")
    out = upsert.merge_with_sql(spark, t, s, "id", ts="2024-03-01 00:00:00")
    got = sorted(((r.id, r.v, str(r.last_updated)) for r in out.collect()), key=repr)
    new, old = "2024-03-01 00:00:00", "None"
    # a key that occurs twice but hits no target row is two inserts, as in MERGE
    assert got == sorted([("a", 1, old), ("b", 20, new), ("c", 30, new), ("c", 31, new), (None, 3, old), (None, 40, new)], key=repr)
    upsert.register_updates(spark.createDataFrame([("b", 20), ("b", 21)], SCHEMA), "harmonized_updates")
    with pytest.raises(Exception, match="more than one source row"):
        upsert.merge_with_sql(spark, t, "harmonized_updates", "id").collect()


def test_compact_sizes_come_from_files_not_from_estimates(spark):
    a = spark.range(0, 3000).select(F.col("id").alias("k"), F.rand(1).alias("x"))
    b = spark.range(0, 3000).select(F.col("id").alias("k"), F.rand(2).alias("y"))
    pa, pb = scratch_path(spark, "a"), scratch_path(spark, "b")
    a.write.parquet(pa)
    b.write.parquet(pb)
    joined = spark.read.parquet(pa).join(spark.read.parquet(pb), "k").join(spark.read.parquet(pa).withColumnRenamed("x", "z"), "k")
    estimate = int(str(joined._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    path = upsert.compact(joined, scratch_path(spark, "joined"), "k", target_bytes=20_000)
    size = upsert.folder_sizes(spark.read.parquet(path)).first()
    want = size["bytes"] / 20_000
    assert want / 2 <= size["files"] <= 2 * want and estimate > 100 * size["bytes"]
    assert spark.read.parquet(path).count() == 3000
    nothing = upsert.compact(joined.where("k < 0"), scratch_path(spark, "none"), "k")
    assert spark.read.schema(joined.schema).parquet(nothing).count() == 0


def test_compact_folder_by_folder(spark):
    rows = spark.range(0, 20_000).select(F.col("id"), F.when(F.col("id") < 19_000, F.lit("big")).otherwise(
        F.concat(F.lit("d"), F.col("id") % 4)).alias("day"), F.rand(3).alias("x"))
    many = scratch_path(spark, "many")
    rows.repartition(10).write.partitionBy("day").parquet(many)
    src = spark.read.parquet(many)
    assert upsert.folder_sizes(src).count() == 5 and upsert.folder_sizes(src).agg(F.sum("files")).first()[0] == 50
    path = upsert.compact(src, scratch_path(spark, "few"), "id", target_bytes=60_000, partition_by=["day"])
    files = {r.folder.rsplit("=", 1)[1]: r.files for r in upsert.folder_sizes(spark.read.parquet(path)).collect()}
    assert 3 <= files["big"] <= 8 and all(files[f"d{i}"] <= 2 for i in range(4))
    back = spark.read.parquet(path)
    assert back.count() == 20_000 and back.agg(F.sum("id")).first()[0] == sum(range(20_000))


def test_as_of_log_reads_only_the_folders_it_needs(spark, changes):
    path = upsert.write_log(changes, scratch_path(spark, "log"))
    assert _state(upsert.as_of_log(spark, path, "id", version=2)) == {"a": 1, "b": 20, "c": 30}
    assert _state(upsert.as_of_log(spark, path, "id", timestamp="2024-01-02 12:00:00")) == {"a": 1, "b": 20, "c": 30}
    assert _state(upsert.as_of_log(spark, path, "id", version=1, timestamp="2024-01-03")) == {"a": 1, "b": 2}
    assert _state(upsert.as_of_log(spark, path, "id", version=0)) == {}
    assert set(upsert.as_of_log(spark, path, "id", version=1).columns) == set(changes.columns)
    with pytest.raises(ValueError, match="Either snapshot_id or timestamp"):
        upsert.as_of_log(spark, path, "id")
    for df, column in ((upsert.as_of_log(spark, path, "id", version=1), "snapshot_id"),
                       (upsert.as_of_log(spark, path, "id", timestamp="2024-01-01 12:00:00"), "commit_date")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert column in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_snapshot_files_reads_no_data_column(spark, changes):
    path = upsert.write_log(changes, scratch_path(spark, "log-files"))
    facts = upsert.snapshot_files(spark, path)
    assert "ReadSchema: struct<>" in facts._jdf.queryExecution().executedPlan().toString()
    got = {r.snapshot_id: (r.n_rows, r.n_days, r.n_files >= 1, r.bytes > 0) for r in facts.collect()}
    assert got == {1: (2, 1, True, True), 2: (2, 1, True, True), 3: (1, 1, True, True)}


def test_registry_metadata(spark):
    from regalign.sources import registry

    bad = registry.registry_metadata(spark, scratch_path(spark, "missing")).first()
    assert bad.error is not None and bad.history_rows is None
    path = scratch_path(spark, "meta")
    registry.write_snapshot(spark.createDataFrame([("a", 1)], SCHEMA), path, 1, "2024-01-01", "id")
    registry.write_snapshot(spark.createDataFrame([("a", 2), ("b", 3)], SCHEMA), path, 2, "2024-01-02", "id")
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        registry.write_snapshot(spark.createDataFrame([("z", 9)], SCHEMA), path, 2, "2024-01-02", "id")
    with pytest.raises(ValueError, match="must not be null"):
        registry.write_snapshot(spark.createDataFrame([(None, 9)], SCHEMA), path, 3, "2024-01-02", "id")
    meta = registry.registry_metadata(spark, path, "id").first()
    assert (meta.current_rows, meta.history_rows, meta.snapshot_count, meta.error) == (2, 3, 2, None)
    assert "v:bigint" in meta.schema and registry.record_count(spark, path, "id").first().n == 2
    assert registry.next_snapshot_id(spark, path) == 3


def test_scratch_is_local_only_on_a_local_master_and_can_be_removed(spark):
    from types import SimpleNamespace

    from regalign import session

    fixed = session.materialize(spark.range(5).toDF("id"), "gone")
    folder = fixed.inputFiles()[0].rsplit("/", 1)[0].replace("file:", "")
    import os

    assert os.path.isdir(folder) and session.cleanup_scratch(spark) > 0 and not os.path.isdir(folder)
    sc = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077", setCheckpointDir=lambda d: None)
    far = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d=None: None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(far)


def test_materialize_writes_under_the_checkpoint_folder(spark):
    from regalign.session import ensure_checkpoint_dir, materialize

    src = spark.range(0, 1000).select(F.col("id"), (F.col("id") % 7).alias("k"))
    fixed = materialize(src.where(F.col("k") != 3), "t")
    files = fixed.inputFiles()
    root = ensure_checkpoint_dir(spark).replace("file:", "")
    assert files and all(root in f for f in files)  # the shared folder, not a machine-local temp dir
    assert "Scan parquet" in fixed.select("id")._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.id for r in fixed.collect()) == [i for i in range(1000) if i % 7 != 3]
    # a second call never overwrites the first table
    again = materialize(src, "t")
    assert again.count() == 1000 and fixed.count() == 1000 - len([i for i in range(1000) if i % 7 == 3])
