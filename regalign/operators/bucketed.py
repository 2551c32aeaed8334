"""MERGE on a stored table without shuffling it: Spark's bucketed tables.

The table is written once into buckets of the merge key.  A merge repartitions the source, usually
the small side, into the same buckets; the target's scan already has them, so no row of it crosses
the network.  The full outer join meets bucket by bucket and each task writes the bucket it holds:
the new version is bucketed in the same way, with one file per bucket, and the merge statistics
are observed while it is written.
"""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from regalign.session import remove_scratch, scratch_path

STATS = ("before_rows", "source_rows", "inserted_keys", "updated_keys", "unchanged_rows", "after_rows")
_DUPLICATE = "MERGE: a target row matches more than one source row"


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """Store ``df`` as the external table ``table``, bucketed and sorted by ``key``; returns its scan.

    ``path`` is a new folder (default: one in the shared scratch folder).  The key is meant to be
    unique, so buckets are of like size.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, "bucketed")
    _store(df.repartition(buckets, key), table, key, buckets, path)
    return spark.table(table)


def _store(df: DataFrame, table: str, key: str, buckets: int, path: str) -> None:
    df.write.format("parquet").option("compression", "snappy").option("path", path).bucketBy(buckets, key).sortBy(
        key).mode("errorifexists").saveAsTable(table)


def bucket_count(spark: SparkSession, table: str) -> int:
    """Number of buckets the table is stored in; raises when it isn't bucketed."""
    facts = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    if not facts.get("Num Buckets"):
        raise ValueError(f"{table} is not bucketed")
    return int(facts["Num Buckets"])


def merged(target: DataFrame, source: DataFrame, key: str, buckets: int, ts=None,
           stamp_col: str | None = "last_updated") -> DataFrame:
    """The merge of a bucketed scan and a source, with flags ``_t`` and ``_s`` of the sides a row came from.

    Matched rows take the source's values (a column the source lacks keeps the target's), new keys
    are inserted, other target rows stay; null keys never match.  A task that meets a target row
    with two source rows fails the job.
    """
    if stamp_col is not None:
        source = source.withColumn(stamp_col, F.current_timestamp() if ts is None else F.lit(ts).cast("timestamp"))
    kind = target.schema[key].dataType  # equal types hash to equal buckets
    side = source.select(*[F.col(f"`{c}`").cast(kind if c == key else source.schema[c].dataType).alias(f"_s_{c}") for c in source.columns])
    side = side.repartition(buckets, f"_s_{key}")
    same = Window.partitionBy(f"_s_{key}")
    side = side.withColumn("_copies", F.when(F.col(f"_s_{key}").isNull(), F.lit(1)).otherwise(F.count(F.lit(1)).over(same))).withColumn(
        "_s", F.lit(True))
    both = target.withColumn("_t", F.lit(True)).join(side, target[key] == side[f"_s_{key}"], "full_outer")
    both = both.withColumn("_t", F.coalesce("_t", F.lit(False))).withColumn("_s", F.coalesce("_s", F.lit(False)))
    twice = F.col("_t") & (F.col("_copies") > 1)

    def value(c: str) -> Column:
        if c not in source.columns:
            return F.col(f"`{c}`")
        if c not in target.columns:
            return F.col(f"`_s_{c}`").alias(c)
        new = F.when(F.col("_s"), F.col(f"`_s_{c}`")).otherwise(F.col(f"`{c}`"))
        return (F.when(twice, F.raise_error(F.lit(_DUPLICATE))).otherwise(new) if c == key else new).alias(c)

    cols = target.columns + [c for c in source.columns if c not in target.columns]
    return both.select(*[value(c) for c in cols], "_t", "_s")


def merge_bucketed(spark: SparkSession, table: str, source: DataFrame, key: str, new_table: str, ts=None,
                   stamp_col: str | None = "last_updated", path: str | None = None) -> tuple[DataFrame, dict[str, int]]:
    """MERGE ``source`` into the bucketed ``table``; the result is stored as ``new_table``, bucketed alike.

    Returns the scan of the new version and its statistics, counted by the job that writes it.
    ``key`` is unique in the target.  Raises ``ValueError`` when a target row matches two source
    rows; nothing is stored then.  Switch readers to the new table, then drop the old one.
    """
    n = bucket_count(spark, table)
    own = path is None
    path = path or scratch_path(spark, "bucketed")
    seen = Observation("merge")
    t, s = F.col("_t"), F.col("_s")
    rows = merged(spark.table(table), source, key, n, ts, stamp_col).observe(
        seen, F.count_if(t).alias("before_rows"), F.count_if(s).alias("source_rows"), F.count_if(s & ~t).alias("inserted_keys"),
        F.count_if(s & t).alias("updated_keys"), F.count_if(t & ~s).alias("unchanged_rows"), F.count(F.lit(1)).alias("after_rows"))
    try:
        _store(rows.drop("_t", "_s"), new_table, key, n, path)
    except PySparkException as err:
        if own:
            remove_scratch(spark, path)
        if _DUPLICATE in str(err):
            raise ValueError(f"{_DUPLICATE} on {key}") from err
        raise
    return spark.table(new_table), {k: int(seen.get[k]) for k in STATS}
