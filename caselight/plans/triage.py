"""From alerts to decisions: the triage steps joined to the results of the monitors."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from caselight.operators import incidents, monitors, quality, similarity
from caselight.plans.reports import freshness_status

EVIDENCE_COLUMN = "drug_name"


def similar_by_incident(neighbours: DataFrame, memory: DataFrame) -> DataFrame:
    """One row per query with the number of neighbours and score and summary of the best one."""
    summaries = memory.select(F.col("incident_id").alias("match_id"), "summary")
    named = neighbours.join(summaries, "match_id", "left")
    first = F.col("rank") == 1
    return named.groupBy(F.col("query_id").alias("incident_id")).agg(
        F.count(F.lit(1)).alias("n_similar"), F.max(F.when(first, F.col("score"))).alias("top_score"),
        F.max(F.when(first, F.col("summary"))).alias("top_summary"),
    )


def reusable_by_incident(queries: DataFrame, memory: DataFrame, min_score: float = similarity.REUSE_SCORE) -> DataFrame:
    """One row per query whose best earlier match with a working fix is similar enough: that fix."""
    found = similarity.reusable_fixes(queries, memory, min_score, order="incident_id")
    fixes = memory.select(F.col("incident_id").alias("match_id"), "description", "risk_level", "sql")
    return found.join(fixes, "match_id").select(
        F.col("query_id").alias("incident_id"), "score", "description", "risk_level", "sql")


def investigate(
    classified: DataFrame, *, similar: DataFrame, memory: DataFrame, live: DataFrame, snapshots: DataFrame,
    stats: DataFrame, baselines: DataFrame, rows: DataFrame, freshness: DataFrame, impact: DataFrame,
) -> DataFrame:
    """Add the evidence for each classified incident from the monitoring tables."""
    table = monitors.TABLE_KEY
    counts = monitors.count_check(stats, baselines).select(*table, "current_count", "baseline_count", "deviation_pct")
    nulls = quality.null_rates(rows, [EVIDENCE_COLUMN], by=table)
    return incidents.gather_evidence(
        classified,
        similar=similar_by_incident(similar, memory),
        diffs=monitors.schema_diff(live, monitors.latest_snapshot(snapshots)),
        counts=counts,
        nulls=nulls,
        freshness=freshness_status(freshness),
        impact=impact,
    )
