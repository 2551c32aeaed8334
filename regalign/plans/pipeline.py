"""End-to-end flow: ingest -> resolve -> collapse -> upsert (new snapshot) -> train and evaluate."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regalign.operators import learn, matching as M, quality, upsert
from regalign.session import materialize, together
from regalign.sources import delimited, registry

log = logging.getLogger(__name__)


@dataclass
class PipelineResult:
    harmonized: DataFrame | None = None
    merge_stats: DataFrame | None = None
    snapshot_id: int | None = None
    metrics: DataFrame | None = None
    notes: list[str] = field(default_factory=list)


def commit_upsert(spark: SparkSession, registry_path: str, source: DataFrame, key: str = "corporate_id",
                  ts=None, snapshot_id: int | None = None) -> tuple[int, DataFrame]:
    """MERGE ``source`` into the registry as a new snapshot; returns (snapshot id, merge stats).

    Only the source rows are written (an upsert changes exactly those keys); the state at
    any snapshot is then ``upsert.as_of`` over the change log.  Rows without a key are counted by
    the pass that fixes the rows.  The statistics read keys only.
    """
    changes = registry.read_changes(spark, registry_path)
    stamp = F.current_timestamp() if ts is None else F.lit(ts).cast("timestamp")
    rows, seen = quality.observed(registry.conform(source.withColumn("last_updated", stamp)), [key])
    rows = materialize(rows, "commit")
    if seen.get[f"null_{key}"]:
        raise ValueError(f"{key} must not be null")
    if not rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        raise ValueError(f"MERGE: more than one source row for a {key}")
    sid = snapshot_id if snapshot_id is not None else registry.next_snapshot_id(spark, registry_path)
    before = rows.select(key).limit(0) if changes is None else changes.where(F.col("snapshot_id") < sid).select(key).distinct()
    stats = upsert.merge_stats(before, rows, key)
    committed = ts if ts is not None else F.current_timestamp()
    registry.write_snapshot(rows, registry_path, sid, committed, key, checked=True)
    return sid, stats


def run(spark: SparkSession, source1_path: str | None, source2_path: str | None, registry_path: str,
        cfg: M.MatchConfig = M.MatchConfig(), skip_ingestion: bool = False, skip_ml: bool = False,
        profit_threshold: float = 1_000_000, ts=None) -> PipelineResult:
    """The whole flow with the reference's two switches.  Everything returned is a DataFrame."""
    res = PipelineResult()
    if not skip_ingestion:
        one, two = delimited.default_specs(source1_path, source2_path)
        lineage = ("source", "ingestion_timestamp")
        lp, rp = together(
            spark, lambda: delimited.ingest(spark, one, ts, lambda s: M.row_numbered(M.prepare_left(s.drop(*lineage), cfg=cfg))),
            lambda: delimited.ingest(spark, two, ts, lambda s: M.row_numbered(M.prepare_right(s.drop(*lineage), cfg=cfg))))
        matches = M.matched_names(lp, rp, cfg).checkpoint(eager=True)
        res.harmonized = M.harmonize(lp, rp, matches, cfg, ts, matches_materialized=True)
        # one row per id before the MERGE (several matched pairs can share an id), computed
        # without forming the pairs
        one_per_id = M.harmonize(lp, rp, matches, cfg, ts, collapsed=True, matches_materialized=True)
        res.snapshot_id, res.merge_stats = commit_upsert(spark, registry_path, one_per_id, ts=ts)
    if not skip_ml:
        changes = registry.read_changes(spark, registry_path)
        if changes is None:
            res.notes.append("no registry yet: training skipped")
            return res
        current = upsert.read_current(changes, "corporate_id")
        data = materialize(learn.prepare_training(current, threshold=profit_threshold))
        try:
            train_df, test_df = learn.hash_split(data, "corporate_id")
            model = learn.train(train_df)
            res.metrics = learn.evaluate(learn.score(model, test_df))
        except ValueError as err:  # e.g. one class only
            log.warning("training skipped: %s", err)
            res.notes.append(f"training skipped: {err}")
    return res
