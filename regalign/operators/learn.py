"""Profit classifier on the registry: preparation, split, pipeline, scoring, metrics.

Model fitting uses Spark ML (assembler -> standard scaler -> elastic-net logistic
regression).  Metrics are computed as DataFrame aggregates so they stay distributed and
come back as one-row tables: accuracy and the weighted precision / recall / F1 from one
confusion-matrix aggregate, and the exact ROC AUC (ties count one half) from distributed
prefix sums over the distinct scores.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regalign.functions.text import binary_label
from regalign.operators.ranking import prefix_sums_global
from regalign.session import materialize

FEATURES = ["revenue", "supplier_count", "customer_count"]
TARGET = "high_profit"


def prepare_training(df: DataFrame, features: list[str] = FEATURES, target: str = TARGET,
                     profit_col: str = "profit", threshold: float = 1_000_000,
                     id_cols: tuple[str, ...] = ("corporate_id", "corporate_name"),
                     required: tuple[str, ...] = ("revenue", "profit", "supplier_count"),
                     fill_zero: tuple[str, ...] = ("customer_count",)) -> DataFrame:
    """Complete rows only, label = profit > threshold, missing counts -> 0, project."""
    cond = None
    for c in required:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    out = df.where(cond).withColumn(target, binary_label(profit_col, threshold))
    out = out.fillna({c: 0 for c in fill_zero})
    return out.select(*features, target, *id_cols)


def class_distribution(df: DataFrame, target: str = TARGET) -> DataFrame:
    return df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))


def hash_split_flag(key, test_fraction: float = 0.2, seed: int = 42):
    """True for the test share: the first 8 hex digits of md5(seed:key) mapped to [0, 1).

    Reproducible across runs and partitionings, and the same rule in any SQL engine.
    """
    h = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), 1, 8), 16, 10)
    return (h.cast("double") / F.lit(float(16 ** 8))) < F.lit(test_fraction)


def hash_split(df: DataFrame, key: str, test_fraction: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, test); together they are ``df``: a row without a key goes to train."""
    flag = F.coalesce(hash_split_flag(key, test_fraction, seed), F.lit(False))
    return df.where(~flag), df.where(flag)


def random_split(df: DataFrame, test_fraction: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Spark's ``randomSplit`` (result depends on the input partitioning)."""
    train, test = df.randomSplit([1 - test_fraction, test_fraction], seed=seed)
    return train, test


def build_pipeline(features: list[str] = FEATURES, target: str = TARGET, max_iter: int = 100,
                   reg_param: float = 0.01, elastic_net: float = 0.5) -> Pipeline:
    assembler = VectorAssembler(inputCols=features, outputCol="features_raw", handleInvalid="error")
    scaler = StandardScaler(inputCol="features_raw", outputCol="features", withStd=True, withMean=True)
    lr = LogisticRegression(featuresCol="features", labelCol=target, maxIter=max_iter, regParam=reg_param,
                            elasticNetParam=elastic_net)
    return Pipeline(stages=[assembler, scaler, lr])


def train(train_df: DataFrame, pipeline: Pipeline | None = None, require_both_classes: bool = True,
          target: str = TARGET) -> PipelineModel:
    """Fit the pipeline; with one class only, raise instead of fitting a degenerate model."""
    if require_both_classes:
        n_classes = train_df.select(target).distinct().limit(2).count()
        if n_classes < 2:
            raise ValueError("training data has a single class; the classifier is undefined")
    return _without_summary((pipeline or build_pipeline(target=target)).fit(train_df))


def _without_summary(model: PipelineModel) -> PipelineModel:
    """The model without its training summary, which nothing here uses.

    The summary holds on to the training session, and a session that has observed metrics can't be
    sent to tasks (SparkSession's observation manager isn't serialisable), so scoring would fail.
    """
    for stage in model.stages:
        if getattr(stage, "hasSummary", False):
            stage._java_obj.setSummary(SparkSession.active()._jvm.scala.Option.empty())
    return model


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Batch scoring: adds prediction and ``p1`` (probability of class 1)."""
    out = model.transform(df)
    return out.withColumn("p1", vector_to_array("probability")[1])


def coefficients(spark: SparkSession, model: PipelineModel, features: list[str] = FEATURES) -> DataFrame:
    lr = model.stages[-1]
    rows = [(i, f, float(c)) for i, (f, c) in enumerate(zip(features, lr.coefficients.toArray()))]
    rows.append((len(features), "intercept", float(lr.intercept)))
    return spark.createDataFrame(rows, "position int, feature string, coefficient double")


def confusion_metrics(pred: DataFrame, label: str = TARGET, prediction: str = "prediction") -> DataFrame:
    """Accuracy and label-weighted precision, recall and F1 (one row).

    Per class c (classes = values present in ``label``): precision = tp/predicted(c)
    (0 when nothing is predicted c), recall = tp/actual(c), F1 = 2pr/(p+r) (0 when p+r=0);
    weights are actual(c)/n.  Weighted recall equals accuracy.
    """
    cells = pred.groupBy(F.col(label).cast("double").alias("_y"), F.col(prediction).cast("double").alias("_p")).agg(
        F.count(F.lit(1)).alias("_n"))
    actual = cells.groupBy("_y").agg(F.sum("_n").alias("_actual"),
                                     F.sum(F.when(F.col("_y") == F.col("_p"), F.col("_n")).otherwise(0)).alias("_tp"))
    predicted = cells.groupBy(F.col("_p").alias("_y")).agg(F.sum("_n").alias("_predicted"))
    per = actual.join(predicted, "_y", "left").fillna({"_predicted": 0})
    per = per.withColumn("_prec", F.when(F.col("_predicted") > 0, F.col("_tp") / F.col("_predicted")).otherwise(0.0))
    per = per.withColumn("_rec", F.col("_tp") / F.col("_actual"))
    per = per.withColumn("_f1", F.when(F.col("_prec") + F.col("_rec") > 0,
                                       F.lit(2.0) * F.col("_prec") * F.col("_rec") / (F.col("_prec") + F.col("_rec")))
                         .otherwise(0.0))
    total = F.sum("_actual")
    # class-weighted sums of doubles are rounded to 12 places so the result does not
    # depend on the order in which partial sums are added
    return per.agg(
        total.alias("n"),
        (F.sum("_tp") / total).alias("accuracy"),
        F.round(F.sum(F.col("_prec") * F.col("_actual")) / total, 12).alias("weighted_precision"),
        F.round(F.sum(F.col("_rec") * F.col("_actual")) / total, 12).alias("weighted_recall"),
        F.round(F.sum(F.col("_f1") * F.col("_actual")) / total, 12).alias("weighted_f1"),
    )


def auc_roc(pred: DataFrame, label: str = TARGET, score_col: str = "p1") -> DataFrame:
    """Exact area under the ROC curve (one row ``auc``): P(score+ > score-) + P(tie)/2.

    Grouped by distinct score, then the count of negatives below each score comes from a
    distributed prefix sum.  Null when a class is missing.  Products are formed as doubles: with
    billions of rows per class they don't fit a long.
    """
    by_score = pred.groupBy(F.col(score_col).cast("double").alias("_s")).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) != 1).alias("_neg"))
    cum = prefix_sums_global(by_score.where(F.col("_s").isNotNull()), "_s", ["_neg"])
    wins = F.sum(F.col("_pos").cast("double") * (F.col("_neg_before").cast("double") + F.col("_neg") * F.lit(0.5)))
    return cum.agg(F.try_divide(wins, F.sum("_pos").cast("double") * F.sum("_neg").cast("double")).alias("auc"))


def evaluate(pred: DataFrame, label: str = TARGET, prediction: str = "prediction", score_col: str = "p1") -> DataFrame:
    """All metrics as (metric, value) rows: the confusion aggregate and the AUC aggregate."""
    m = confusion_metrics(pred, label, prediction)
    long = m.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"))
        for c in ("accuracy", "weighted_precision", "weighted_recall", "weighted_f1")
    ])).alias("m")).select("m.*")
    a = auc_roc(pred, label, score_col).select(F.lit("auc").alias("metric"), F.col("auc").alias("value"))
    return long.unionByName(a)


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def train_and_evaluate(df: DataFrame, key: str = "corporate_id", test_fraction: float = 0.2, seed: int = 42,
                       threshold: float = 1_000_000, pipeline: Pipeline | None = None):
    """Prepare -> split -> fit -> score the test share -> metrics.  Returns (model, metrics frame).

    The prepared rows are materialised once: the fit and the evaluation read them several
    times, and recomputing the registry behind them on every pass would dominate.
    """
    data = materialize(prepare_training(df, threshold=threshold))
    train_df, test_df = hash_split(data, key, test_fraction, seed)
    model = train(train_df, pipeline)
    return model, evaluate(score(model, test_df))
