"""Driver query catalogue: name -> f(spark, sf_dir) -> DataFrame (whole tables)."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regalign.functions import lcs_expr
from regalign.functions.similarity import name_features, score_name_pairs
from regalign.functions.text import categorize, extract_city, list_size, normalize_name, parse_id
from regalign.operators import bucketed, learn, matching as M, quality, upsert
from regalign.plans import pipeline, views as V
from regalign.session import ensure_checkpoint_dir, materialize, parallelism, scratch_path, together
from regalign.sources import delimited, registry

Query = Callable[[SparkSession, str], DataFrame]
CFG = M.MatchConfig()
FIXED_TS = "2024-01-01 00:00:00"


# ------------------------------------------------------------------ matching
class _Match:
    """The matching plan over the driver views.

    Each part is built when first asked for.  The name tables read only the name column of the
    views; the prepared rows are written (with row ids, without the city) only for the queries
    that need whole rows.  Writing them and checkpointing the name tables are jobs of their own.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        ensure_checkpoint_dir(spark)
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def sides(self) -> list[DataFrame]:
        """Both sides prepared and written, with row ids and without the city."""
        return together(
            self.spark,
            lambda: M.with_row_id(M.prepare_left(V.supply_view(self.spark, self.sf_dir), cfg=CFG).drop("city"), "supply-prepared"),
            lambda: M.with_row_id(M.prepare_right(V.finance_view(self.spark, self.sf_dir), cfg=CFG), "finance-prepared"))

    @property
    def left(self) -> DataFrame:
        return self.sides[0]

    @property
    def right(self) -> DataFrame:
        return self.sides[1]

    @cached_property
    def names(self) -> list[DataFrame]:
        """The name tables, bounded by distinct names and read by several consumers."""
        left, right = self.__dict__.get("sides") or (M.prepare_left(V.supply_view(self.spark, self.sf_dir), cfg=CFG),
                                                     M.prepare_right(V.finance_view(self.spark, self.sf_dir), cfg=CFG))
        return together(self.spark, *[
            lambda df=df, p=p: M.distinct_names(df.select("normalized_name"), p, CFG.block_chars, materialize=True)
            for df, p in ((left, "l"), (right, "r"))])

    @property
    def ln(self) -> DataFrame:
        return self.names[0]

    @property
    def rn(self) -> DataFrame:
        return self.names[1]

    def candidates(self) -> DataFrame:
        # the small name tables are shuffled into one partition per core by (key, cell), so
        # the pairs come out spread and are scored where they are made
        return M.candidate_pairs(self.ln, self.rn, CFG.threshold, CFG.weights,
                                 num_partitions=parallelism(self.ln.sparkSession))

    def matches(self) -> DataFrame:
        return M.score_pairs(self.candidates(), CFG.threshold, CFG.weights, respread=False).select(
            "l_name", "r_name", "similarity_score")

    def harmonized(self, ts=FIXED_TS, collapsed: bool = False, part: str = "all") -> DataFrame:
        left, right = self.left, self.right  # before the name tables, which then read these
        return M.harmonize(left, right, self.matches(), CFG, ts, collapsed=collapsed, part=part,
                           left_names=self.ln, right_names=self.rn)


def _no_ts(df: DataFrame) -> DataFrame:
    return df.drop("harmonization_timestamp", "last_updated", "harmonization_date")


def q_normalize_names(spark, d):
    return V.supply_view(spark, d).select("row_id", "corporate_name_s1",
                                          normalize_name("corporate_name_s1").alias("normalized_name"))


def q_normalize_finance_names(spark, d):
    return V.finance_view(spark, d).select("row_id", "corporate_name_s2",
                                           normalize_name("corporate_name_s2").alias("normalized_name"))


def q_extract_city(spark, d):
    sup = V.table(spark, d, "supplier")
    nat = V.table(spark, d, "nation")  # 25 rows
    addr = F.when(F.col("s_suppkey") % 4 == 0, F.concat(F.lit("PO Box "), F.col("s_suppkey").cast("string"))).otherwise(
        F.concat(F.col("s_suppkey").cast("string"), F.lit(" Main Street, "), F.col("n_name"), F.lit(", ST "),
                 F.col("s_nationkey").cast("string")))
    j = sup.join(F.broadcast(nat), nat.n_nationkey == sup.s_nationkey).select("s_suppkey", addr.alias("address"))
    return j.withColumn("city", extract_city("address"))


def q_list_sizes(spark, d):
    docs = V.table(spark, d, "documents")
    return docs.select("doc_id", list_size("text").alias("n_items"), list_size("source").alias("n_sources"))


def q_supplier_counts(spark, d):
    v = V.supply_view(spark, d)
    return v.select("row_id", list_size("top_suppliers").alias("supplier_count"),
                    list_size("activity_places").alias("place_count"))


def q_null_profile_events(spark, d):
    return quality.null_profile(V.table(spark, d, "events"),
                                ["event_id", "ts", "user_id", "event_type", "value", "props"])


def q_null_profile_orders(spark, d):
    return quality.null_profile(V.table(spark, d, "orders"), ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"])


def q_contract_check(spark, d):
    from pyspark.sql import types as T
    contract = T.StructType([
        T.StructField("l_orderkey", T.LongType(), False),
        T.StructField("l_partkey", T.LongType(), False),
        T.StructField("l_suppkey", T.LongType(), False),
        T.StructField("l_linenumber", T.IntegerType(), False),
        T.StructField("l_quantity", T.DoubleType(), True),
        T.StructField("l_extendedprice", T.DoubleType(), True),
        T.StructField("l_discount", T.DoubleType(), True),
        T.StructField("l_tax", T.DoubleType(), True),
        T.StructField("l_returnflag", T.StringType(), True),
        T.StructField("l_linestatus", T.StringType(), True),
        T.StructField("l_shipdate", T.TimestampType(), True),
    ])
    return quality.check_contract(V.table(spark, d, "lineitem"), contract, key="l_orderkey")


def q_block_stats(spark, d):
    m = _Match(spark, d)
    return M.block_stats(m.ln, m.rn)


def _own_names(spark, d):
    """Each part's supply name next to the finance name of its own (name, brand): one row per such part."""
    part = V.table(spark, d, "part").select("p_partkey", "p_name", "p_brand")
    own = part.groupBy("p_name", "p_brand").agg(F.min("p_partkey").alias("k"))
    own = part.join(own, ["p_name", "p_brand"]).select(F.col("p_partkey").alias("row_id"), "k")
    left = V.supply_view(spark, d).select("row_id", normalize_name("corporate_name_s1").alias("l_name"))
    right = V.finance_view(spark, d).select(F.col("row_id").alias("k"), normalize_name("corporate_name_s2").alias("r_name"))
    return left.join(own, "row_id").join(right, "k").select("row_id", "l_name", "r_name")


def q_name_similarity(spark, d):
    pairs = name_features(name_features(_own_names(spark, d), "l_name", "l"), "r_name", "r")
    return score_name_pairs(pairs, "l", "r", CFG.weights, keep=["row_id"]).select(
        "row_id", "l_name", "r_name", "ratio", "token_sort", "token_set", "similarity_score")


def q_name_similarity_expr(spark, d):
    """The same scores from column expressions only, once per distinct pair of names."""
    pairs = _own_names(spark, d)
    l, r = F.col("l_name"), F.col("r_name")
    scored = pairs.select("l_name", "r_name").distinct().select(
        "l_name", "r_name", lcs_expr.indel_ratio(l, r).alias("ratio"), lcs_expr.token_sort_ratio(l, r).alias("token_sort"),
        lcs_expr.token_set_ratio(l, r).alias("token_set"), lcs_expr.name_similarity(l, r, CFG.weights).alias("similarity_score"))
    return pairs.join(scored, ["l_name", "r_name"]).select(
        "row_id", "l_name", "r_name", "ratio", "token_sort", "token_set", "similarity_score")


def q_matches(spark, d):
    return _Match(spark, d).matches()


def q_assign_ids(spark, d):
    return M.assign_ids(_Match(spark, d).matches().select("l_name").distinct(), "l_name", CFG,
                        names_are_distinct=True).select(
        "l_name", "corporate_id", parse_id("corporate_id").cast("long").alias("id_number"))


def q_unmatched(spark, d):
    h = _Match(spark, d).harmonized(part="unmatched")
    return h.select(
        "corporate_id", "corporate_name", "normalized_name", "address", "activity_places", "top_suppliers",
        "supplier_count")


def q_harmonize(spark, d):
    return _no_ts(_Match(spark, d).harmonized())


def q_collapse_by_id(spark, d):
    # one row per id without forming all matched row pairs first
    return _no_ts(_Match(spark, d).harmonized(collapsed=True))


def q_collapse_after_harmonize(spark, d):
    return _no_ts(M.collapse_by_id(_Match(spark, d).harmonized()))


def q_sample_rows(spark, d):
    # the sample display: first five harmonised rows in id order (the limit is the feature)
    h = _no_ts(_Match(spark, d).harmonized())
    return h.orderBy("corporate_id", "corporate_name", "address", F.col("revenue").desc_nulls_last(),
                     "main_customers").limit(5)


def q_ids_per_entity(spark, d):
    return _Match(spark, d).harmonized().groupBy("corporate_id").agg(F.count(F.lit(1)).alias("n"))


def q_entity_summary(spark, d):
    return _Match(spark, d).harmonized().agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("corporate_id").alias("n_entities"),
        F.count_if(F.col("revenue").isNull()).alias("n_unmatched"))


def q_registry_roundtrip(spark, d):
    path = scratch_path(spark, "registry")
    registry.write_registry(_Match(spark, d).harmonized(), path)
    reg = registry.read_registry(spark, path).where(F.col("harmonization_date") == F.lit("2024-01-01").cast("date"))
    return _no_ts(reg)


def q_registry_count(spark, d):
    path = scratch_path(spark, "registry-count")
    before = registry.record_count(spark, path)  # absent table -> 0
    registry.write_registry(_Match(spark, d).harmonized(), path)
    return registry.record_count(spark, path).select(F.col("n"), F.lit(before.first()["n"]).alias("n_before"))


def q_csv_roundtrip(spark, d):
    # every fourth name holds quotes and a comma
    path = scratch_path(spark, "finance-csv")
    name = F.col("corporate_name_s2")
    quoted = F.when(F.col("row_id") % 4 == 0, F.concat(F.lit('The "'), name, F.lit('", Inc'))).otherwise(name)
    V.finance_view(spark, d).withColumn("corporate_name_s2", quoted).drop("row_id").write.option("header", "true").csv(path)
    back = delimited.with_lineage(delimited.read_delimited(spark, path, delimited.FINANCIAL_SCHEMA), "source2")
    return back.drop("ingestion_timestamp")


def q_ingest_sources(spark, d):
    """Both views through files: written as CSV, read with their schemas, validated, with lineage."""
    s1, s2 = scratch_path(spark, "source1-csv"), scratch_path(spark, "source2-csv")
    V.supply_view(spark, d).drop("row_id").write.option("header", "true").csv(s1)
    V.finance_view(spark, d).drop("row_id").write.option("header", "true").csv(s2)
    one, two = delimited.ingest_all(spark, delimited.default_specs(s1, s2), FIXED_TS)
    return one.select(F.col("corporate_name_s1").alias("name"), F.col("top_suppliers").alias("items"), "source").unionByName(
        two.select(F.col("corporate_name_s2").alias("name"), F.col("main_customers").alias("items"), "source"))


def q_feature_contract(spark, d):
    """The feature columns the training set lacks, per needed feature."""
    data = _training(spark, d)
    missing = quality.feature_contract(data.columns, [*learn.FEATURES, "n_employees"])
    return data.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("missing", F.lit(",".join(missing)))


# ------------------------------------------------------------------ upsert and history
def _orders_split(spark, d):
    o = V.table(spark, d, "orders")
    target = o.where(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz"))
    source = o.where(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")).withColumn(
        "o_totalprice", F.col("o_totalprice") * F.lit(1.1))
    return target, source


def q_merge_upsert(spark, d):
    t, s = _orders_split(spark, d)
    return upsert.merge_upsert(t, s, "o_orderkey", stamp_col=None)


def q_merge_wide(spark, d):
    """The target has columns the source lacks; matched rows keep them, new rows have null there."""
    t, s = _orders_split(spark, d)
    return upsert.merge_upsert(t, s.drop("o_custkey", "o_orderpriority"), "o_orderkey", stamp_col=None)


def q_registry_metadata(spark, d):
    """Two commits to a change log on disk: current records, change rows and commits it reports."""
    t, s = _orders_split(spark, d)
    path = scratch_path(spark, "orders-log")
    registry.write_snapshot(t, path, 1, FIXED_TS, "o_orderkey")
    registry.write_snapshot(s, path, registry.next_snapshot_id(spark, path), "2024-01-02 00:00:00", "o_orderkey")
    n = registry.record_count(spark, path, "o_orderkey").select(F.col("n").alias("record_count"))
    meta = registry.registry_metadata(spark, path, "o_orderkey").select(
        "n_columns", "current_rows", "history_rows", "snapshot_count")
    return meta.join(n)  # one row each


def q_merge_stats(spark, d):
    t, s = _orders_split(spark, d)
    return upsert.merge_stats(t, s, "o_orderkey")


def q_compact_orders(spark, d):
    path = scratch_path(spark, "orders-compact")
    upsert.compact(V.table(spark, d, "orders"), path, sort_key="o_orderkey")
    return spark.read.parquet(path)


def q_compact_joined(spark, d):
    """A joined frame compacted into files of 1 MB; whether their number is within twice its bytes / 1 MB."""
    o, li = V.table(spark, d, "orders"), V.table(spark, d, "lineitem")
    joined = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "o_custkey", "o_orderdate")
    path, mb = scratch_path(spark, "joined-compact"), 1 << 20
    upsert.compact(joined, path, sort_key=["l_orderkey", "l_linenumber"], target_bytes=mb)
    back = spark.read.parquet(path)
    size = upsert.folder_sizes(back).first()
    want = max(1.0, size["bytes"] / mb)
    return back.withColumn("files_fit", F.lit(want / 2 <= size["files"] <= 2 * want + 1))


def q_compact_folders(spark, d):
    """Orders stored by year in many small files, compacted folder by folder: rows and files of each."""
    o = V.table(spark, d, "orders").withColumn("o_year", F.year("o_orderdate"))
    many, path = scratch_path(spark, "orders-small-files"), scratch_path(spark, "orders-by-year")
    o.repartition(12).write.partitionBy("o_year").parquet(many)
    upsert.compact(spark.read.parquet(many), path, sort_key="o_orderkey", partition_by=["o_year"])
    back = spark.read.parquet(path)
    files = back.groupBy("o_year", F.col("_metadata.file_path").alias("f")).agg(
        F.count(F.lit(1)).alias("n"), F.max("_metadata.file_size").alias("size"))
    return files.groupBy("o_year").agg(F.sum("n").alias("n_rows"), (
        F.count(F.lit(1)) <= 2 * F.ceil(F.sum("size") / upsert.TARGET_FILE_BYTES)).alias("files_fit"))


def _merge_bucketed(spark, d):
    t, s = _orders_split(spark, d)
    name = "orders_" + uuid.uuid4().hex
    bucketed.write_bucketed(t, name, "o_orderkey", buckets=parallelism(spark))
    return bucketed.merge_bucketed(spark, name, s, "o_orderkey", name + "_merged", stamp_col=None)


def q_merge_bucketed(spark, d):
    """The merge of orders on a stored, bucketed table: the new version as stored."""
    return _merge_bucketed(spark, d)[0]


def q_merge_bucketed_stats(spark, d):
    """What the job that wrote the new version counted."""
    stats = _merge_bucketed(spark, d)[1]
    return spark.range(1).select(*[F.lit(stats[k]).cast("long").alias(k) for k in bucketed.STATS])


def q_merge_sql_view(spark, d):
    """The MERGE as one SQL query over registered views, stamped with a given time."""
    t, s = _orders_split(spark, d)
    t = t.withColumn("last_updated", F.lit(None).cast("timestamp"))
    target = upsert.register_updates(t, "orders_target")
    updates = upsert.register_updates(s, "harmonized_updates")
    return upsert.merge_with_sql(spark, target, updates, "o_orderkey", ts=FIXED_TS)


def _event_log(spark, d):
    return upsert.write_log(_event_changes(spark, d), scratch_path(spark, "event-log"))


def q_as_of_log(spark, d):
    """States by snapshot and by time, each read from a log on disk of one folder a day."""
    path = _event_log(spark, d)
    noon = F.lit("2024-01-10 12:00:00").cast("timestamp_ntz")
    by_id = upsert.as_of_log(spark, path, "user_id", version=20240115, version_cols=_EV_ORDER)
    by_time = upsert.as_of_log(spark, path, "user_id", timestamp=noon, version_cols=_EV_ORDER)
    return by_id.withColumn("asked", F.lit("version")).unionByName(by_time.withColumn("asked", F.lit("timestamp")))


def q_snapshot_files(spark, d):
    """What each snapshot of the event log holds on disk."""
    facts = upsert.snapshot_files(spark, _event_log(spark, d))
    return facts.select("snapshot_id", "n_rows", "n_days", (F.col("n_files") >= F.col("n_days")).alias("file_per_day"),
                        (F.col("bytes") > 0).alias("has_bytes"), (F.col("newest_file") <= F.current_timestamp()).alias("written_before_now"))


def _event_changes(spark, d):
    e = V.table(spark, d, "events")
    return e.select("user_id", "event_id", "ts", "event_type", "value", "props",
                    F.date_format("ts", "yyyyMMdd").cast("long").alias("snapshot_id"),
                    F.col("ts").alias("committed_at"))


_EV_ORDER = ["snapshot_id", "committed_at", "event_id"]


def q_as_of_version(spark, d):
    return upsert.as_of(_event_changes(spark, d), "user_id", version=20240115, version_cols=_EV_ORDER)


def q_as_of_timestamp(spark, d):
    return upsert.as_of(_event_changes(spark, d), "user_id",
                        timestamp=F.lit("2024-01-10 12:00:00").cast("timestamp_ntz"), version_cols=_EV_ORDER)


def q_current_state(spark, d):
    return upsert.read_current(_event_changes(spark, d), "user_id", _EV_ORDER)


def q_snapshot_log(spark, d):
    return upsert.snapshot_log(_event_changes(spark, d), "user_id")


def q_expire(spark, d):
    return upsert.expire(_event_changes(spark, d), "user_id", F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"),
                         version_cols=_EV_ORDER)


# ------------------------------------------------------------------ end to end
def _two_commits(spark, d):
    """The whole flow twice over files: the views as CSV, then the same with doubled figures a day later."""
    supply, finance = V.supply_view(spark, d).drop("row_id"), V.finance_view(spark, d).drop("row_id")
    s1, s2, s3 = (scratch_path(spark, f"{n}-csv") for n in ("supply", "finance", "finance-next"))
    supply.write.option("header", "true").csv(s1)
    finance.write.option("header", "true").csv(s2)
    finance.withColumn("revenue", F.col("revenue") * 2).withColumn("profit", F.col("profit") * 2).write.option("header", "true").csv(s3)
    path = scratch_path(spark, "registry-log")
    first = pipeline.run(spark, s1, s2, path, CFG, skip_ml=True, ts=FIXED_TS)
    second = pipeline.run(spark, s1, s3, path, CFG, skip_ml=True, ts="2024-01-02 00:00:00")
    return path, first, second


def q_pipeline_two_commits(spark, d):
    """The current state after two commits."""
    path, _, _ = _two_commits(spark, d)
    state = upsert.read_current(registry.read_changes(spark, path), "corporate_id")
    return _no_ts(state).drop("snapshot_id", "committed_at")


def q_pipeline_commit_stats(spark, d):
    """What each of the two commits did to the registry."""
    _, first, second = _two_commits(spark, d)
    one, two = (r.merge_stats.withColumn("snapshot_id", F.lit(r.snapshot_id).cast("long")) for r in (first, second))
    return one.unionByName(two)


# ------------------------------------------------------------------ reports
def q_high_profit(spark, d):
    sf = V.supplier_finance(spark, d)
    return sf.where((F.col("profit") > 1_000_000) & F.col("revenue").isNotNull()).orderBy(F.col("profit").desc())


def q_top_revenue(spark, d):
    sf = V.supplier_finance(spark, d)
    return sf.where(F.col("revenue").isNotNull()).orderBy(F.col("revenue").desc(), F.col("s_suppkey")).limit(10).select(
        "s_suppkey", "s_name", "revenue")


def q_profit_category(spark, d):
    return V.supplier_finance(spark, d).select("s_suppkey", categorize("profit", 1_000_000).alias("category"))


def q_category_counts(spark, d):
    return q_profit_category(spark, d).groupBy("category").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ learning
def _training(spark, d):
    return learn.prepare_training(V.customer_registry(spark, d))


def q_prepare_training(spark, d):
    return _training(spark, d)


def q_class_distribution(spark, d):
    return learn.class_distribution(_training(spark, d))


def q_scaled_features(spark, d):
    data = _training(spark, d)
    assemble_and_scale = Pipeline(stages=learn.build_pipeline().getStages()[:2])
    feats = assemble_and_scale.fit(data).transform(data)
    arr = vector_to_array("features")
    return feats.select("corporate_id", *[F.round(arr[i], 6).alias(f"{c}_scaled") for i, c in enumerate(learn.FEATURES)])


def q_hash_split(spark, d):
    return _training(spark, d).select("corporate_id", learn.hash_split_flag("corporate_id").alias("is_test"))


def q_split_complete(spark, d):
    """Train and test together are the input, rows without a key included (customers without an order)."""
    o = V.table(spark, d, "orders").select("o_custkey", "o_orderkey")
    rows = V.table(spark, d, "customer").select("c_custkey").join(o, F.col("c_custkey") == F.col("o_custkey"), "left")
    train, test = learn.hash_split(rows.select("c_custkey", "o_orderkey"), "o_orderkey")
    return train.withColumn("is_test", F.lit(False)).unionByName(test.withColumn("is_test", F.lit(True)))


def q_random_split(spark, d):
    """Spark's random split of the training rows: shares add up, no row is in both, the test share is near a fifth."""
    data = materialize(_training(spark, d))
    train, test = learn.random_split(data, 0.2, seed=42)
    parts = train.select("corporate_id", F.lit(0).alias("t")).unionByName(test.select("corporate_id", F.lit(1).alias("t")))
    both = parts.groupBy("corporate_id").agg(F.count(F.lit(1)).alias("n"), F.sum("t").alias("t"))
    return both.agg(F.sum("n").alias("n_rows"), F.coalesce(F.max("n") == 1, F.lit(True)).alias("no_row_twice"),
                    F.avg("t").between(0.15, 0.25).alias("share_near"))


def q_train_and_evaluate(spark, d):
    """Preparation, split, fit and metrics in one call: the metrics, and whether each is a share."""
    _, metrics = learn.train_and_evaluate(V.customer_registry(spark, d))
    return metrics.select("metric", F.col("value").between(0, 1).alias("in_range"))


def _rule_predictions(spark, d):
    lab = V.table(spark, d, "labels")
    docs = V.table(spark, d, "documents").select("doc_id", "n_chars")
    n = F.col("n_chars").cast("double")
    return lab.join(docs, "doc_id").select(
        "doc_id", F.col("quality").cast("double").alias("label"), (n / (n + F.lit(1000.0))).alias("p1"),
        F.when(F.col("n_chars") > 1000, F.lit(1.0)).otherwise(F.lit(0.0)).alias("prediction"))


def q_metrics_confusion(spark, d):
    return learn.confusion_metrics(_rule_predictions(spark, d), label="label", prediction="prediction")


def q_metrics_auc(spark, d):
    return learn.auc_roc(_rule_predictions(spark, d), label="label", score_col="p1")


def q_train_score(spark, d):
    data = materialize(_training(spark, d))  # read by the class check, the fit and the scoring
    train_df, test_df = learn.hash_split(data, "corporate_id")
    model = learn.train(train_df)
    path = learn.save_model(model, scratch_path(spark, "model"))
    fitted = learn.score(model, test_df).select("corporate_id", F.col("p1").alias("p1_fitted"))
    scored = learn.score(learn.load_model(path), test_df).join(fitted, "corporate_id")
    return scored.select("corporate_id", "high_profit", (F.col("prediction") == (F.col("p1") > 0.5).cast("double")).alias(
        "prediction_follows_p1"), (F.col("p1") == F.col("p1_fitted")).alias("loaded_as_fitted"))


def q_coefficients(spark, d):
    """Per coefficient, whether the elastic-net optimality condition holds on the training rows.

    With g the mean of (p1 - y) * x: |g + l2 * w + l1 * sign(w)| is 0 for w != 0, |g| <= l1 for
    w = 0, and the mean of p1 - y is 0 for the intercept; within 1e-3.
    """
    data = materialize(_training(spark, d))
    train_df, _ = learn.hash_split(data, "corporate_id")
    model = learn.train(train_df)
    reg, alpha, tol = 0.01, 0.5, 1e-3
    off = F.col("p1") - F.col("high_profit")
    x = vector_to_array("features")
    grads = learn.score(model, train_df).agg(
        *[F.avg(off * x[i]).alias(c) for i, c in enumerate(learn.FEATURES)], F.avg(off).alias("intercept"))
    grads = grads.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("g"))
                                             for c in [*learn.FEATURES, "intercept"]])).alias("x")).select("x.*")
    w = F.col("coefficient")
    rest = F.when(F.col("feature") == "intercept", F.abs("g")).when(w == 0, F.abs("g") - reg * alpha).otherwise(
        F.abs(F.col("g") + reg * (1 - alpha) * w + reg * alpha * F.signum(w)))
    return learn.coefficients(spark, model).join(grads, "feature").select("position", "feature", (rest <= tol).alias("optimal"))


def q_model_metrics(spark, d):
    """Test rows of a fitted model, and whether its metrics agree with each other and with Spark ML's evaluators."""
    data = materialize(_training(spark, d))
    train_df, test_df = learn.hash_split(data, "corporate_id")
    pred = materialize(learn.score(learn.train(train_df), test_df).select(
        "high_profit", "prediction", "p1", "rawPrediction"), "scored")
    auc = BinaryClassificationEvaluator(labelCol="high_profit", numBins=0).evaluate(pred)
    m = learn.confusion_metrics(pred)
    return m.join(learn.auc_roc(pred)).select(  # one row each
        "n", (F.abs(F.col("weighted_recall") - F.col("accuracy")) < 1e-9).alias("recall_is_accuracy"),
        (F.abs(F.col("auc") - F.lit(float(auc))) < 1e-6).alias("auc_as_evaluator"),
        F.col("accuracy").between(0, 1).alias("accuracy_in_range"))


QUERIES: dict[str, Query] = {
    "normalize_names": q_normalize_names,
    "normalize_finance_names": q_normalize_finance_names,
    "extract_city": q_extract_city,
    "list_sizes": q_list_sizes,
    "supplier_counts": q_supplier_counts,
    "null_profile_events": q_null_profile_events,
    "null_profile_orders": q_null_profile_orders,
    "contract_check": q_contract_check,
    "block_stats": q_block_stats,
    "name_similarity": q_name_similarity,
    "name_similarity_expr": q_name_similarity_expr,
    "matches": q_matches,
    "assign_ids": q_assign_ids,
    "unmatched": q_unmatched,
    "harmonize": q_harmonize,
    "collapse_by_id": q_collapse_by_id,
    "collapse_after_harmonize": q_collapse_after_harmonize,
    "sample_rows": q_sample_rows,
    "ids_per_entity": q_ids_per_entity,
    "entity_summary": q_entity_summary,
    "registry_roundtrip": q_registry_roundtrip,
    "registry_count": q_registry_count,
    "csv_roundtrip": q_csv_roundtrip,
    "ingest_sources": q_ingest_sources,
    "merge_upsert": q_merge_upsert,
    "merge_stats": q_merge_stats,
    "merge_wide": q_merge_wide,
    "registry_metadata": q_registry_metadata,
    "compact_orders": q_compact_orders,
    "compact_joined": q_compact_joined,
    "compact_folders": q_compact_folders,
    "merge_bucketed": q_merge_bucketed,
    "merge_bucketed_stats": q_merge_bucketed_stats,
    "merge_sql_view": q_merge_sql_view,
    "as_of_log": q_as_of_log,
    "snapshot_files": q_snapshot_files,
    "as_of_version": q_as_of_version,
    "as_of_timestamp": q_as_of_timestamp,
    "current_state": q_current_state,
    "snapshot_log": q_snapshot_log,
    "expire": q_expire,
    "pipeline_two_commits": q_pipeline_two_commits,
    "pipeline_commit_stats": q_pipeline_commit_stats,
    "high_profit": q_high_profit,
    "top_revenue": q_top_revenue,
    "profit_category": q_profit_category,
    "category_counts": q_category_counts,
    "prepare_training": q_prepare_training,
    "class_distribution": q_class_distribution,
    "scaled_features": q_scaled_features,
    "feature_contract": q_feature_contract,
    "hash_split": q_hash_split,
    "split_complete": q_split_complete,
    "random_split": q_random_split,
    "train_and_evaluate": q_train_and_evaluate,
    "metrics_confusion": q_metrics_confusion,
    "metrics_auc": q_metrics_auc,
    "train_score": q_train_score,
    "coefficients": q_coefficients,
    "model_metrics": q_model_metrics,
}
