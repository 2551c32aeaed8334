"""Session helpers: build a local session for tests/bench and locate shared scratch space."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


_scratch: dict[str, list[str]] = {}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "regalign",
                  driver_memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks (on a cluster, pass your own session)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", driver_memory)
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    A private temporary folder is set only on a local master with none configured; on a cluster
    executors would each write to their own disk, so a missing setting raises.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a remote session has no SparkContext; use the conf
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    current = sc.getCheckpointDir()
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if not current:
            master = sc.master
            if master != "local" and not master.startswith("local["):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            current = tempfile.mkdtemp(prefix="regalign-ckpt-")
        sc.setCheckpointDir(current)
        current = sc.getCheckpointDir() or current
    return current


def materialize(df: DataFrame, name: str = "materialized") -> DataFrame:
    """Fix ``df`` once for several passes: a Parquet table written in the shared folder.

    Used before multi-pass work (a model fit scans its input for the class check, the
    scaler statistics and the optimizer's instances; the prepared match sides feed the
    name tables, the anti join and the row-pair joins).  Each pass then reads compressed,
    column-pruned files instead of recomputing the joins, aggregates and regexes behind
    them, the planner sees real file sizes, and a lost executor re-reads files instead of
    recomputing from the sources.  The path is unique per call under
    ``spark.checkpoint.dir`` (the cluster's shared folder), so a retried job rewrites
    only its own output through the commit protocol.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)  # a known schema saves the job that reads footers


def together(spark: SparkSession, *jobs: Callable[[], DataFrame]) -> list[DataFrame]:
    """Results of independent jobs, started at the same time so that one fills the cores another leaves idle.

    For a few jobs that don't depend on each other, such as writing both sides of a match.
    """
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]]


def parallelism(spark: SparkSession) -> int:
    """Cores available to the job (at least the configured shuffle partitions)."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        n = max(n, spark.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001 - remote session
        pass
    return n


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder for written intermediate tables."""
    path = os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def remove_scratch(spark: SparkSession, *paths: str) -> None:
    """Delete scratch tables of this session that nothing reads any more."""
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    own = _scratch.get(spark.sparkContext.applicationId, [])
    for path in paths:
        if path not in own:
            raise ValueError(f"not a scratch table of this session: {path}")
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
        own.remove(path)


def cleanup_scratch(spark: SparkSession) -> int:
    """Delete every scratch table this session has written; returns how many there were.

    Call it when the results built on them have been written: frames that read them stop working.
    """
    paths = list(_scratch.get(spark.sparkContext.applicationId, []))
    remove_scratch(spark, *paths)
    return len(paths)
