"""Data-quality checks: emptiness, null counts and schema contracts, each in one pass."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)


def null_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row: ``n_rows`` and ``null_<col>`` for each column, computed in one aggregate.

    ``count_if`` is 0 (not null) on empty input.
    """
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in cols]
    return df.agg(*aggs)


def observed(df: DataFrame, required: list[str]) -> tuple[DataFrame, Observation]:
    """``df`` that counts its rows and nulls (the columns of ``null_profile``) when it is next written or read.

    The counts come from the pass that uses the rows, so a check costs no job of its own.
    """
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("n_rows"),
                      *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in required]), seen


def judge(counts: dict, required: list[str], source_name: str) -> bool:
    """Raise ``ValueError("No data found in ...")`` when the counts say the source is empty; log nulls."""
    if counts["n_rows"] == 0:
        raise ValueError(f"No data found in {source_name}")
    for c in required:
        n = counts[f"null_{c}"]
        if n:
            log.warning("%s: found %d null values in %s", source_name, n, c)
    return True


def validate(df: DataFrame, required: list[str], source_name: str) -> bool:
    """Raise ``ValueError("No data found in ...")`` on an empty frame; log null counts.

    Emptiness and null counts come from the same single aggregate job.
    """
    return judge(null_profile(df, required).first().asDict(), required, source_name)


def check_contract(df: DataFrame, contract: T.StructType, key: str | None = None) -> DataFrame:
    """Violations of a schema contract as rows (column, problem, expected, actual, null_rows).

    Checks: each contract column is present with the same type; no extra columns; the
    columns declared not-null hold no nulls (counted in one aggregate over the data).
    """
    spark = df.sparkSession
    actual = {f.name: f for f in df.schema.fields}
    rows = []
    for f in contract.fields:
        a = actual.get(f.name)
        if a is None:
            rows.append((f.name, "missing", f.dataType.simpleString(), None))
        elif a.dataType != f.dataType:
            rows.append((f.name, "type", f.dataType.simpleString(), a.dataType.simpleString()))
    wanted = {f.name for f in contract.fields}
    for name, a in actual.items():
        if name not in wanted:
            rows.append((name, "extra", None, a.dataType.simpleString()))
    schema = "column string, problem string, expected string, actual string"
    static = spark.createDataFrame(rows, schema).withColumn("null_rows", F.lit(None).cast("long"))
    not_null = [f.name for f in contract.fields if (not f.nullable or f.name == key) and f.name in actual]
    if not not_null:
        return static
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in not_null])
    stacked = counts.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("null_rows")) for c in not_null
    ])).alias("s")).select("s.*")
    nulls = stacked.where(F.col("null_rows") > 0).select(
        "column", F.lit("nulls").alias("problem"), F.lit("not null").alias("expected"),
        F.lit("nullable").alias("actual"), "null_rows")
    return static.unionByName(nulls)


def feature_contract(columns: list[str], expected: list[str]) -> list[str]:
    """Names of expected feature columns that are missing (empty list when satisfied)."""
    return [c for c in expected if c not in set(columns)]
