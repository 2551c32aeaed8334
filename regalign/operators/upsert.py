"""Upsert, time travel, snapshot log, expiry and compaction on plain Parquet tables.

The registry is kept as an append-only *change table*: every row carries the key, the
payload, ``snapshot_id`` (monotone) and ``committed_at``.  Because an upsert never
deletes, the state at snapshot ``v`` is exactly the newest change per key with
``snapshot_id <= v``.  All state reads keep the first row per key in falling version order,
reduced to one row per key and task before the shuffle, however hot a key is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regalign.operators.ranking import first_per_key
from regalign.session import remove_scratch, scratch_path


def _latest_per_key(df: DataFrame, key: str | list[str], order: list[str]) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    newest = [F.col(f"`{c}`").desc_nulls_last() for c in [*order, *(c for c in rest if c not in order)]]
    return first_per_key(df, keys, newest).select(*keys, *rest)


def merge_upsert(target: DataFrame, source: DataFrame, key: str, ts=None, stamp_col: str | None = "last_updated",
                 check_cardinality: bool = True) -> DataFrame:
    """MERGE target USING source ON key: matched rows take the source values, new keys are
    inserted, target rows without a source row stay; nothing is deleted.

    ``key`` is unique in the target.  All columns of both sides are kept: a matched row keeps the
    target's value of a column the source lacks, an inserted one has null there.  With
    ``stamp_col`` the source rows get that column set to the merge time.  A source key that occurs
    twice and hits a target row raises (the MERGE cardinality rule) unless ``check_cardinality`` is
    off; the check is one aggregate job over the source's keys.  Null keys never match.

    Planned as the source next to an anti join of the target with the source's keys, so columns
    that aren't used are read from neither side; only columns the source lacks are joined to it.
    """
    src = source
    if stamp_col is not None:
        stamp = F.current_timestamp() if ts is None else F.lit(ts).cast("timestamp")
        src = src.withColumn(stamp_col, stamp)
    if check_cardinality:
        dup = source.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
        if not dup.isEmpty() and not dup.join(target.select(key), key, "left_semi").isEmpty():
            raise ValueError(f"MERGE: a target row matches more than one source row on {key}")
    cols = target.columns + [c for c in src.columns if c not in target.columns]
    lacking = [c for c in target.columns if c not in src.columns]
    if lacking:
        held = target.select(F.col(key).alias("_k"), *[F.col(f"`{c}`") for c in lacking])
        src = src.join(held, src[key] == held["_k"], "left").drop("_k")
    keys = source.select(F.col(key).alias("_k"))
    rest = target.join(keys, target[key] == keys["_k"], "left_anti")
    return src.unionByName(rest, allowMissingColumns=True).select(*[F.col(f"`{c}`") for c in cols])


def merge_stats(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """One row: rows before, source rows, inserted, updated, unchanged target rows, after."""
    t = target.groupBy(key).agg(F.count(F.lit(1)).alias("_t"))
    s = source.groupBy(key).agg(F.count(F.lit(1)).alias("_s"))
    j = t.join(s, key, "full_outer")
    return j.agg(
        F.coalesce(F.sum("_t"), F.lit(0)).alias("before_rows"),
        F.coalesce(F.sum("_s"), F.lit(0)).alias("source_rows"),
        F.count_if(F.col("_t").isNull()).alias("inserted_keys"),
        F.count_if(F.col("_t").isNotNull() & F.col("_s").isNotNull()).alias("updated_keys"),
        F.coalesce(F.sum(F.when(F.col("_s").isNull(), F.col("_t"))), F.lit(0)).alias("unchanged_rows"),
        (F.coalesce(F.sum(F.when(F.col("_s").isNull(), F.col("_t"))), F.lit(0))
         + F.coalesce(F.sum("_s"), F.lit(0))).alias("after_rows"),
    )


def append_changes(changes: DataFrame | None, upserted_rows: DataFrame, snapshot_id: int, committed_at) -> DataFrame:
    """Rows of one commit, tagged with its snapshot id and time, appended to the log."""
    tagged = upserted_rows.withColumn("snapshot_id", F.lit(snapshot_id).cast("long")).withColumn(
        "committed_at", F.lit(committed_at).cast("timestamp"))
    return tagged if changes is None else changes.unionByName(tagged)


def read_current(changes: DataFrame, key: str, version_cols: list[str] | None = None) -> DataFrame:
    """Latest state: newest change per key."""
    return _latest_per_key(changes, key, version_cols or ["snapshot_id"])


def as_of(changes: DataFrame, key: str, version: int | None = None, timestamp: str | Column | None = None,
          version_cols: list[str] | None = None, version_col: str = "snapshot_id",
          time_col: str = "committed_at") -> DataFrame:
    """State as of a snapshot id (wins when both are given) or a commit time.

    Raises ``ValueError`` when neither is given.  Before the first snapshot the result is
    empty.
    """
    if version is not None:
        visible = changes.where(F.col(version_col) <= F.lit(version))
    elif timestamp is not None:
        t = timestamp if isinstance(timestamp, Column) else F.lit(timestamp).cast("timestamp")
        visible = changes.where(F.col(time_col) <= t)
    else:
        raise ValueError("Either snapshot_id or timestamp must be provided")
    return _latest_per_key(visible, key, version_cols or [version_col])


def snapshot_log(changes: DataFrame, key: str, version_col: str = "snapshot_id",
                 time_col: str = "committed_at") -> DataFrame:
    """One row per snapshot: commit time, changed rows and keys."""
    return changes.groupBy(version_col).agg(
        F.max(time_col).alias("committed_at"),
        F.count(F.lit(1)).alias("changed_rows"),
        F.count_distinct(key).alias("changed_keys"),
    )


def expire(changes: DataFrame, key: str, before, version_cols: list[str] | None = None,
           time_col: str = "committed_at") -> DataFrame:
    """Drop history older than ``before``: changes at or after it stay, and the older ones
    fold into one row per key (its newest), so every state from ``before`` on is unchanged.
    """
    t = before if isinstance(before, Column) else F.lit(before).cast("timestamp")
    old = changes.where(F.col(time_col) < t)
    recent = changes.where(~(F.col(time_col) < t) | F.col(time_col).isNull())
    folded = _latest_per_key(old, key, version_cols or ["snapshot_id"])
    return folded.select(*changes.columns).unionByName(recent)


# ------------------------------------------------------------------ a change log on disk
LOG_DAY = "commit_date"


def write_log(changes: DataFrame, path: str, version_col: str = "snapshot_id", time_col: str = "committed_at") -> str:
    """Write a change log divided by commit day and snapshot, so that reads of a state prune folders.

    Rows of one folder are brought together by a rebalance, which adaptive execution splits when a
    folder holds much of the data; it is sized by bytes, not by the number of folders.
    """
    tagged = changes.withColumn(LOG_DAY, F.to_date(time_col))
    tagged.hint("rebalance", LOG_DAY, version_col).write.mode("errorifexists").option("compression", "snappy").partitionBy(
        LOG_DAY, version_col).parquet(path)
    return path


def read_log(spark: SparkSession, path: str, version_col: str = "snapshot_id") -> DataFrame:
    """The change log with typed partition columns (day a date, snapshot a long)."""
    found = spark.read.parquet(path).schema
    kinds = {version_col: T.LongType(), LOG_DAY: T.DateType()}
    return spark.read.schema(T.StructType([T.StructField(f.name, kinds.get(f.name, f.dataType), True) for f in found])).parquet(path)


def as_of_log(spark: SparkSession, path: str, key: str, version: int | None = None, timestamp: str | Column | None = None,
              version_cols: list[str] | None = None, version_col: str = "snapshot_id", time_col: str = "committed_at") -> DataFrame:
    """``as_of`` over a written log: only folders of days and snapshots up to the asked state are read.

    A time also bounds the commit day, which is a partition column, so the scan's partition filters
    prune by folder before a row is read; within the last day the commit time itself decides.
    """
    log = read_log(spark, path, version_col)
    if version is None and timestamp is not None:
        t = timestamp if isinstance(timestamp, Column) else F.lit(timestamp).cast("timestamp")
        log = log.where(F.col(LOG_DAY) <= F.to_date(t))
    return as_of(log, key, version, timestamp, version_cols, version_col, time_col).drop(LOG_DAY)


def snapshot_files(spark: SparkSession, path: str, version_col: str = "snapshot_id") -> DataFrame:
    """One row per snapshot of a written log: rows, days, files, bytes and the time of the newest file.

    Comes from partition values and the scan's hidden file columns; rows are counted from file
    footers and no data column is read.
    """
    log = read_log(spark, path, version_col)
    files = log.groupBy(version_col, LOG_DAY, F.col("_metadata.file_path").alias("_file")).agg(
        F.count(F.lit(1)).alias("_rows"), F.max("_metadata.file_size").alias("_bytes"),
        F.max("_metadata.file_modification_time").alias("_time"))
    return files.groupBy(version_col).agg(
        F.sum("_rows").alias("n_rows"), F.count_distinct(LOG_DAY).alias("n_days"), F.count(F.lit(1)).alias("n_files"),
        F.sum("_bytes").alias("bytes"), F.max("_time").alias("newest_file"))


# ------------------------------------------------------------------ compaction
TARGET_FILE_BYTES = 128 << 20


def folder_sizes(df: DataFrame) -> DataFrame:
    """(folder, files, bytes) of the files a table scan reads, from the hidden file columns."""
    files = df.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")).distinct()
    return files.groupBy(F.regexp_replace("file", "/[^/]*$", "").alias("folder")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"))


def _reads_files(df: DataFrame) -> bool:
    """Whether ``df`` is all of a file table: then its files are its size."""
    node = df._jdf.queryExecution().analyzed()
    while node.nodeName() == "SubqueryAlias":
        node = node.children().head()
    return "LogicalRelation" in node.nodeName()


def file_count(df: DataFrame, target_bytes: int = TARGET_FILE_BYTES) -> int:
    """Files of about ``target_bytes`` that the files of a table scan come to, each folder counted by itself."""
    n = folder_sizes(df).agg(F.sum(F.ceil(F.col("bytes") / F.lit(target_bytes)))).first()[0]
    return max(1, int(n or 0))


def compact(df: DataFrame, path: str, sort_key: str | list[str], target_bytes: int = TARGET_FILE_BYTES,
            mode: str = "errorifexists", partition_by: list[str] | None = None) -> str:
    """Rewrite into range-partitioned files of about ``target_bytes``, sorted by ``sort_key``; returns ``path``.

    The number of files follows from the size of files, never from the optimizer's estimate, which
    multiplies sizes at joins: a frame that isn't a whole file table is written to the shared folder
    first (and that copy removed at the end).  With ``partition_by`` each folder gets the files its
    own bytes need; ranges follow folder and key, so a small folder is one file.

    Write to a new path (never the one being read), then switch readers to it.
    """
    keys = [sort_key] if isinstance(sort_key, str) else list(sort_key)
    folders = partition_by or []
    copy = None
    if not _reads_files(df) or folders:
        copy = scratch_path(df.sparkSession, "compact")
        df.write.partitionBy(*folders).parquet(copy)
    src = df if copy is None else df.sparkSession.read.schema(df.schema).parquet(copy).select(df.columns)
    n_files = file_count(src, target_bytes)
    w = src.repartitionByRange(n_files, *folders, *keys).sortWithinPartitions(*folders, *keys).write.mode(mode).option(
        "compression", "snappy")
    if folders:
        w = w.partitionBy(*folders)
    w.parquet(path)
    if copy is not None:
        remove_scratch(df.sparkSession, copy)
    return path


def register_updates(df: DataFrame, name: str = "harmonized_updates") -> str:
    """Expose a frame to SQL under ``name`` (session-scoped temp view); returns the name."""
    df.createOrReplaceTempView(name)
    return name


def merge_sql(target_view: str, source_view: str, key: str, columns: list[str], stamp_col: str | None = None,
              ts: str | None = None) -> str:
    """The MERGE upsert of two views with the same ``columns`` (in any order) as one SQL query, by column name.

    With ``stamp_col`` the source rows carry the merge time there (``ts`` or the query's time); a
    source key that occurs twice and hits a target row makes the query fail, as MERGE does.
    """
    stamp = "current_timestamp()" if ts is None else f"TIMESTAMP '{ts}'"
    error = f"raise_error('MERGE: a target row matches more than one source row on {key}')"
    taken = ", ".join(f"{stamp} AS `{c}`" if c == stamp_col else f"CASE WHEN hit._k IS NULL THEN s.`{c}` ELSE {error} END AS `{c}`"
                      if c == key else f"s.`{c}`" for c in columns)
    kept = ", ".join(f"t.`{c}`" for c in columns)
    return f"""
WITH s AS (SELECT *, count(*) OVER (PARTITION BY `{key}`) AS _copies FROM {source_view}),
hit AS (
  SELECT DISTINCT t.`{key}` AS _k FROM {target_view} t
  LEFT SEMI JOIN (SELECT `{key}` FROM s WHERE _copies > 1) d ON d.`{key}` = t.`{key}`)
SELECT {taken} FROM s LEFT JOIN hit ON hit._k = s.`{key}`
UNION ALL
SELECT {kept} FROM {target_view} t LEFT ANTI JOIN {source_view} s ON s.`{key}` = t.`{key}`"""


def merge_with_sql(spark: SparkSession, target_view: str, source_view: str, key: str, ts: str | None = None,
                   stamp_col: str = "last_updated") -> DataFrame:
    """Run ``merge_sql`` over two registered views; the columns are the target's, one of them ``stamp_col``."""
    return spark.sql(merge_sql(target_view, source_view, key, spark.table(target_view).columns, stamp_col, ts))
