"""Delimited-file scans against declared schemas, with lineage columns."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regalign.operators.quality import judge, observed
from regalign.session import materialize

SUPPLY_CHAIN_SCHEMA = T.StructType([
    T.StructField("corporate_name_s1", T.StringType(), False),
    T.StructField("address", T.StringType(), True),
    T.StructField("activity_places", T.StringType(), True),
    T.StructField("top_suppliers", T.StringType(), True),
])

FINANCIAL_SCHEMA = T.StructType([
    T.StructField("corporate_name_s2", T.StringType(), False),
    T.StructField("main_customers", T.StringType(), True),
    T.StructField("revenue", T.LongType(), True),
    T.StructField("profit", T.LongType(), True),
])


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",",
                   header: bool = True, mode: str = "PERMISSIVE", escape: str = "\\") -> DataFrame:
    """CSV scan with a declared schema (never inferred); quoted fields may hold the separator.

    A quote inside a quoted field is escaped by ``escape`` (the reader's default, a backslash).
    In PERMISSIVE mode a malformed number becomes null.  The CSV reader does not enforce
    not-null, so the fields come back nullable; ``validate`` reports the nulls.
    """
    return (
        spark.read.schema(schema)
        .option("header", str(header).lower())
        .option("inferSchema", "false")
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", escape)
        .option("mode", mode)
        .csv(path)
    )


def with_lineage(df: DataFrame, source: str, ts=None) -> DataFrame:
    """Add ``source`` (literal) and ``ingestion_timestamp`` (query time unless given)."""
    stamp = F.current_timestamp() if ts is None else F.lit(ts).cast("timestamp")
    return df.withColumn("source", F.lit(source)).withColumn("ingestion_timestamp", stamp)


@dataclass(frozen=True)
class SourceSpec:
    name: str
    path: str
    schema: T.StructType
    required: tuple[str, ...]


def default_specs(source1_path: str, source2_path: str) -> list[SourceSpec]:
    return [
        SourceSpec("source1", source1_path, SUPPLY_CHAIN_SCHEMA, ("corporate_name_s1",)),
        SourceSpec("source2", source2_path, FINANCIAL_SCHEMA, ("corporate_name_s2", "revenue", "profit")),
    ]


def ingest(spark: SparkSession, spec: SourceSpec, ts=None, prepare: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Read a source, add lineage, and write it once to the shared folder, validated by that write.

    Row and null counts are observed while the rows are written, so the file is parsed once and the
    check is no job of its own.  ``prepare`` is applied before the write (normalised names, row
    ids), so the written rows are the ones later passes read.  Raises on an empty source.
    """
    rows, seen = observed(with_lineage(read_delimited(spark, spec.path, spec.schema), spec.name, ts), list(spec.required))
    out = materialize(prepare(rows) if prepare else rows, spec.name)
    judge(seen.get, list(spec.required), spec.name)
    return out


def ingest_all(spark: SparkSession, specs: list[SourceSpec], ts=None) -> list[DataFrame]:
    """Every source by ``ingest`` (raises on an empty source)."""
    return [ingest(spark, spec, ts) for spec in specs]
