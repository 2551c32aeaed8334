"""Sources, data quality, registry layout, training data, metrics."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from regalign.operators import learn, quality
from regalign.session import scratch_path
from regalign.sources import delimited, registry

from paths import DATA


def test_ingest_and_validate(spark):
    s1, s2 = delimited.ingest_all(spark, delimited.default_specs(os.path.join(DATA, "source1.csv"),
                                                                 os.path.join(DATA, "source2.csv")))
    assert s1.count() == 12 and s2.count() == 12
    assert {"source", "ingestion_timestamp"} <= set(s1.columns)
    assert s1.where(F.col("address").contains(",")).count() == 12  # quoted commas survive
    assert s1.where(F.col("corporate_name_s1") == 'Juniper "Old Mill" Bakery').count() == 1  # embedded quotes too


def _jobs(spark, action):
    """Jobs an action starts."""
    sc, group = spark.sparkContext, uuid.uuid4().hex
    sc.setJobGroup(group, group)
    try:
        action()
        return len(sc.statusTracker().getJobIdsForGroup(group))
    finally:
        sc.setJobGroup("other", "other")


def test_ingest_checks_in_the_pass_that_writes(spark, tmp_path):
    one, _ = delimited.default_specs(os.path.join(DATA, "source1.csv"), os.path.join(DATA, "source2.csv"))
    plain = _jobs(spark, lambda: delimited.with_lineage(delimited.read_delimited(spark, one.path, one.schema), "s").write.parquet(
        scratch_path(spark, "plain")))
    assert _jobs(spark, lambda: delimited.ingest(spark, one)) == plain
    empty = tmp_path / "empty.csv"
    empty.write_text("corporate_name_s1,address,activity_places,top_suppliers\n")
    with pytest.raises(ValueError, match="No data found in source1"):
        delimited.ingest(spark, delimited.default_specs(str(empty), str(empty))[0])
    rows, seen = quality.observed(spark.createDataFrame([("A", None), (None, "x")], "a string, b string"), ["a", "b"])
    rows.write.format("noop").mode("overwrite").save()
    assert seen.get == {"n_rows": 2, "null_a": 1, "null_b": 1}


def test_validate_empty_raises(spark):
    empty = spark.createDataFrame([], "corporate_name_s1 string, address string")
    with pytest.raises(ValueError, match="No data found"):
        quality.validate(empty, ["corporate_name_s1"], "source1")
    full = spark.createDataFrame([("A", None), (None, "x")], "corporate_name_s1 string, address string")
    assert quality.validate(full, ["corporate_name_s1"], "source1") is True
    assert quality.null_profile(full, ["corporate_name_s1", "address"]).first().asDict() == {
        "n_rows": 2, "null_corporate_name_s1": 1, "null_address": 1}


def test_malformed_number_becomes_null(spark, tmp_path):
    p = tmp_path / "bad.csv"
    p.write_text("corporate_name_s2,main_customers,revenue,profit\nA,x,12x,5\n")
    row = delimited.read_delimited(spark, str(p), delimited.FINANCIAL_SCHEMA).first()
    assert row.revenue is None and row.profit == 5


def test_contract(spark):
    df = spark.createDataFrame([(None, "x")], "corporate_id string, extra string")
    v = {(r.column, r.problem) for r in quality.check_contract(df, registry.REGISTRY_SCHEMA, key="corporate_id").collect()}
    assert ("corporate_id", "nulls") in v and ("extra", "extra") in v and ("last_updated", "missing") in v
    assert quality.feature_contract(["revenue", "supplier_count"], learn.FEATURES) == ["customer_count"]


def test_registry_roundtrip(spark, sources):
    from regalign.operators.matching import resolve_entities

    path = scratch_path(spark, "registry-test")
    assert registry.record_count(spark, path).first().n == 0
    registry.write_registry(resolve_entities(*sources, ts="2024-01-01 00:00:00"), path)
    assert registry.registry_exists(spark, path)
    back = registry.read_registry(spark, path)
    assert back.count() == 13 and registry.record_count(spark, path).first().n == 13
    assert set(registry.REGISTRY_SCHEMA.fieldNames()) <= set(back.columns)


def _ml_frame(spark):
    rows = [("CORP_1", "A", 10_000_000, 800_000, 3, 2), ("CORP_2", "B", 50_000_000, 2_500_000, 5, 4),
            ("CORP_3", "C", 1_000_000, 50_000, 1, None), ("CORP_4", "D", 30_000_000, 1_800_000, 4, 3),
            ("CORP_5", "E", 500_000, 30_000, 1, 1)]
    return spark.createDataFrame(rows, "corporate_id string, corporate_name string, revenue long, profit long, "
                                       "supplier_count long, customer_count long")


def test_prepare_training_labels(spark):
    prep = learn.prepare_training(_ml_frame(spark))
    labels = [r.high_profit for r in prep.orderBy("corporate_id").collect()]
    assert labels == [0, 1, 0, 1, 0]
    assert {r.high_profit: r.n for r in learn.class_distribution(prep).collect()} == {0: 3, 1: 2}
    assert prep.where(F.col("customer_count").isNull()).count() == 0


def test_pipeline_and_metrics(spark):
    prep = learn.prepare_training(_ml_frame(spark))
    assert len(learn.build_pipeline().getStages()) == 3
    model = learn.train(prep)
    pred = learn.score(model, prep)
    m = {r.metric: r.value for r in learn.evaluate(pred).collect()}
    assert set(m) == {"accuracy", "weighted_precision", "weighted_recall", "weighted_f1", "auc"}
    assert m["weighted_recall"] == pytest.approx(m["accuracy"])
    from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
    assert m["auc"] == pytest.approx(BinaryClassificationEvaluator(labelCol="high_profit", numBins=0).evaluate(pred))
    for name, key in [("accuracy", "accuracy"), ("weightedPrecision", "weighted_precision"), ("f1", "weighted_f1")]:
        ev = MulticlassClassificationEvaluator(labelCol="high_profit", metricName=name)
        assert m[key] == pytest.approx(ev.evaluate(pred))
    coef = learn.coefficients(spark, model).collect()
    assert [r.feature for r in coef] == learn.FEATURES + ["intercept"]


def test_scoring_works_in_a_session_that_has_observed(spark):
    rows, seen = quality.observed(spark.range(3), ["id"])
    rows.write.format("noop").mode("overwrite").save()
    assert seen.get["n_rows"] == 3
    prep = learn.prepare_training(_ml_frame(spark))
    assert learn.score(learn.train(prep), prep).count() == 5


def test_single_class_refused(spark):
    prep = learn.prepare_training(_ml_frame(spark), threshold=0)
    with pytest.raises(ValueError, match="single class"):
        learn.train(prep)


def test_hash_split_is_stable(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("k"))
    a1, b1 = learn.hash_split(df, "k")
    a2, b2 = learn.hash_split(df.repartition(7), "k")
    assert sorted(r.k for r in b1.collect()) == sorted(r.k for r in b2.collect())
    assert 300 < b1.count() < 500


def test_create_registry_once(spark):
    path = scratch_path(spark, "create-registry")
    assert registry.create_registry(spark, path) is True
    assert registry.create_registry(spark, path) is False
    back = registry.read_registry(spark, path)
    assert back.count() == 0 and set(registry.REGISTRY_SCHEMA.fieldNames()) <= set(back.columns)


def test_split_keeps_rows_without_a_key(spark):
    df = spark.createDataFrame([("a",), (None,), (None,), ("b",)], "k string")
    train, test = learn.hash_split(df, "k")
    assert train.count() + test.count() == 4 and train.where("k is null").count() == 2


def test_auc_of_one_class_and_with_ties(spark):
    one = spark.createDataFrame([(1, 0.3), (1, 0.4)], "y int, p1 double")
    assert learn.auc_roc(one, "y").first().auc is None
    both = spark.createDataFrame([(1, 0.9), (0, 0.1), (1, 0.1)], "y int, p1 double")
    assert learn.auc_roc(both, "y").first().auc == 0.75
