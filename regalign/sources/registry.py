"""The harmonised registry table: typed layout, day partitions, existence and counts."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The registry contract, in its column order.
REGISTRY_SCHEMA = T.StructType([
    T.StructField("corporate_id", T.StringType(), False),
    T.StructField("corporate_name", T.StringType(), True),
    T.StructField("normalized_name", T.StringType(), True),
    T.StructField("address", T.StringType(), True),
    T.StructField("activity_places", T.StringType(), True),
    T.StructField("top_suppliers", T.StringType(), True),
    T.StructField("supplier_count", T.IntegerType(), True),
    T.StructField("main_customers", T.StringType(), True),
    T.StructField("customer_count", T.IntegerType(), True),
    T.StructField("revenue", T.LongType(), True),
    T.StructField("profit", T.LongType(), True),
    T.StructField("similarity_score", T.DoubleType(), True),
    T.StructField("harmonization_timestamp", T.TimestampType(), True),
    T.StructField("last_updated", T.TimestampType(), True),
])

PARTITION_COLUMN = "harmonization_date"


def conform(df: DataFrame, schema: T.StructType = REGISTRY_SCHEMA) -> DataFrame:
    """Select and cast to the registry layout (missing columns become typed nulls)."""
    cols = []
    for f in schema.fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def write_registry(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """Write the registry as Parquet (snappy), partitioned by the day of the harmonisation time.

    Readers filtering on ``harmonization_date`` get partition pruning.
    """
    out = conform(df).withColumn(PARTITION_COLUMN, F.to_date("harmonization_timestamp"))
    (out.write.mode(mode).option("compression", "snappy").partitionBy(PARTITION_COLUMN).parquet(path))
    return path


def create_registry(spark: SparkSession, path: str) -> bool:
    """Create the empty typed, day-partitioned registry at ``path`` unless one exists.

    Returns True when it was created.
    """
    if registry_exists(spark, path):
        return False
    write_registry(spark.createDataFrame([], REGISTRY_SCHEMA), path, mode="errorifexists")
    return True


def registry_exists(spark: SparkSession, path: str) -> bool:
    """True if a readable table is at ``path`` (an empty committed table counts); False on any error."""
    try:
        spark.read.parquet(path).schema  # noqa: B018 - resolves the files
        return True
    except Exception:  # noqa: BLE001 - any failure means "not there" ...
        pass
    try:  # ... unless a committed write left no data files (an empty table)
        spark.read.text(f"{path}/_SUCCESS").schema  # noqa: B018
        return True
    except Exception:  # noqa: BLE001
        return False


STORED_SCHEMA = T.StructType(REGISTRY_SCHEMA.fields + [T.StructField(PARTITION_COLUMN, T.DateType(), True)])


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """The registry with its declared schema (no inference; works for an empty table too)."""
    return spark.read.schema(STORED_SCHEMA).parquet(path)


def record_count(spark: SparkSession, path: str, key: str = "corporate_id") -> DataFrame:
    """One row ``n``: 0 when the table is absent, else the number of current records.

    On a change log (``snapshot_id`` partitions) that is the number of keys, not of change rows.
    """
    if not registry_exists(spark, path):
        return spark.range(1).select(F.lit(0).cast("long").alias("n"))
    changes = read_changes(spark, path)
    if changes is not None and "snapshot_id" in changes.columns:
        return changes.agg(F.count_distinct(key).alias("n"))
    return read_registry(spark, path).agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- change log on disk
def read_changes(spark: SparkSession, path: str) -> DataFrame | None:
    """The registry's change log (one partition directory per snapshot), or None if absent or empty."""
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def next_snapshot_id(spark: SparkSession, path: str) -> int:
    """max(snapshot_id) + 1, or 1 for a new table; reads partition values, no data columns."""
    changes = read_changes(spark, path)
    if changes is None:
        return 1
    top = changes.agg(F.max("snapshot_id").alias("m")).first()["m"]
    return 1 if top is None else int(top) + 1


def write_snapshot(rows: DataFrame, path: str, snapshot_id: int, committed_at, key: str = "corporate_id",
                   checked: bool = False) -> None:
    """Write one commit's rows as the new partition ``snapshot_id=N``, divided by day.

    Fails if the snapshot exists (nothing is ever replaced) and if a row has no key (unless the
    caller has ``checked`` that).  One writer at a time: the folder is checked when the write begins.
    """
    if not checked and not rows.where(F.col(key).isNull()).isEmpty():
        raise ValueError(f"{key} must not be null")
    tagged = rows.withColumn("committed_at", F.lit(committed_at).cast("timestamp"))
    days = []
    if "harmonization_timestamp" in rows.columns:
        tagged, days = tagged.withColumn(PARTITION_COLUMN, F.to_date("harmonization_timestamp")), [PARTITION_COLUMN]
    tagged.write.mode("errorifexists").option("compression", "snappy").parquet(
        f"{path}/snapshot_id={snapshot_id}", partitionBy=days or None)


def registry_metadata(spark: SparkSession, path: str, key: str = "corporate_id") -> DataFrame:
    """One row: path, schema, column count, current records, change rows, commits; ``error`` if unreadable."""
    schema = ("path string, schema string, n_columns int, current_rows long, history_rows long, snapshot_count long, "
              "error string")
    try:
        changes = spark.read.parquet(path)
        log = "snapshot_id" in changes.columns
        return changes.agg(
            F.lit(path).alias("path"), F.lit(changes.schema.simpleString()).alias("schema"),
            F.lit(len(changes.columns)).alias("n_columns"),
            (F.count_distinct(key) if log else F.count(F.lit(1))).cast("long").alias("current_rows"),
            F.count(F.lit(1)).alias("history_rows"),
            (F.count_distinct("snapshot_id") if log else F.lit(None)).cast("long").alias("snapshot_count"),
            F.lit(None).cast("string").alias("error"))
    except Exception as err:  # noqa: BLE001 - reported as a row, as the reference returns an error entry
        return spark.createDataFrame([(path, None, None, None, None, None, str(err))], schema)
