"""Reporting queries over the monitoring tables and the marts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from caselight.functions import labels
from caselight.functions.measures import local_time, percent, seconds_between
from caselight.operators.latest import latest_per_key, newest

# Tasks of one load in order, and the label of each.
TASKS = {
    "check_drill": "Check Drill",
    "extract_reports": "Extract Reports",
    "validate_schema": "Validate Schema",
    "load_reports": "Load Reports",
    "build_models": "Build Models",
}
LOAD_TASK = "load_reports"

# Decisions that mean a failure was healed.
HEALED = ["auto_approved", "approved"]


def run_summary(runs: DataFrame) -> DataFrame:
    """Number of runs, share of runs whose tasks all succeeded, start of the last run; (0, null, null) without runs."""
    per_run = runs.groupBy("run_id").agg(
        F.bool_and(F.col("status") == "success").alias("all_success"), F.min("started_at").alias("run_started_at")
    )
    totals = per_run.agg(
        F.count(F.lit(1)).alias("total_runs"), F.count_if("all_success").alias("successful"),
        F.max("run_started_at").alias("last_run_at"),
    )
    return totals.select("total_runs", percent(F.col("successful"), F.col("total_runs")).alias("success_rate"),
                         "last_run_at")


def _healed(incidents: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys that have a healing decision."""
    return incidents.where(F.col("fix_result").isin(HEALED)).select(*keys).distinct().withColumn("healed", F.lit(True))


def run_stages(runs: DataFrame, incidents: DataFrame, run_ids: DataFrame) -> DataFrame:
    """Task rows of the given runs with ``healed``: a decision that healed this very run and task exists."""
    rows = runs.join(run_ids, "run_id", "left_semi")
    keys = ["run_id", "task_id"]
    return rows.join(_healed(incidents, keys), keys, "left").withColumn("healed", F.coalesce("healed", F.lit(False)))


def latest_run(runs: DataFrame) -> DataFrame:
    """run_id of the run that started last."""
    return newest(runs, [F.desc_nulls_last("started_at"), F.desc("run_id")]).select("run_id")


def latest_run_stages(
    runs: DataFrame, incidents: DataFrame, tasks: Mapping[str, str] = TASKS
) -> DataFrame:
    """Every task of the load with its state in the latest run: label, duration and whether it was healed."""
    stages = run_stages(runs, incidents, latest_run(runs))
    plan = runs.sparkSession.createDataFrame(
        [(i, task, label) for i, (task, label) in enumerate(tasks.items())], "position int, task_id string, task string"
    )
    joined = plan.join(stages.drop("dag_id", "run_id"), "task_id", "left")
    label = labels.stage_label(F.col("status"), F.coalesce("healed", F.lit(False)))
    seconds = F.when(label != "Running", seconds_between(F.col("started_at"), F.col("finished_at")))
    return joined.withColumns({"stage_label": label, "duration": labels.duration_label(seconds)})


def unhealed_failures(stages: DataFrame) -> DataFrame:
    """Failed stages nobody healed, with their error text."""
    return stages.where((F.col("status") == "failed") & ~F.col("healed")).withColumn(
        "error_message", F.coalesce(F.nullif("error_message", F.lit("")), F.lit("(no error message recorded)"))
    )


def run_states(runs: DataFrame, load_task: str = LOAD_TASK) -> DataFrame:
    """One row per run: outcome flags, start, end and records loaded."""
    return runs.groupBy("run_id", "dag_id").agg(
        F.bool_and(F.col("status") == "success").alias("all_success"),
        F.bool_or(F.col("status") == "failed").alias("any_failed"),
        F.min("started_at").alias("started_at"),
        F.max("finished_at").alias("finished_at"),
        F.max(F.when(F.col("task_id") == load_task, F.col("rows_processed"))).alias("records"),
    )


def labelled_runs(states: DataFrame, incidents: DataFrame) -> DataFrame:
    """Run states with ``healed``, status label and duration."""
    joined = states.join(_healed(incidents, ["run_id"]), "run_id", "left")
    healed = F.coalesce("healed", F.lit(False))
    return joined.withColumn("healed", healed).withColumns({
        "status": labels.run_label(F.col("healed"), F.col("any_failed"), F.col("all_success")),
        "duration": labels.duration_label(seconds_between(F.col("started_at"), F.col("finished_at"))),
    })


def recent_runs(runs: DataFrame, incidents: DataFrame, n: int = 10, load_task: str = LOAD_TASK) -> DataFrame:
    """The ``n`` runs that started last. The limit comes first, so only those runs meet the incidents."""
    states = newest(run_states(runs, load_task), [F.desc_nulls_last("started_at"), F.desc("run_id")], n)
    return labelled_runs(states, incidents)


def freshness_status(checks: DataFrame) -> DataFrame:
    """Latest check of each table; tables of one name in two schemas are two tables."""
    last = latest_per_key(checks, ["schema_name", "table_name"], [F.desc_nulls_first("checked_at")])
    return last.select("table_name", "schema_name", "last_loaded", "is_stale",
                       F.coalesce("data_source", F.lit("live")).alias("data_source"))


def uses_cache(status: DataFrame) -> DataFrame:
    """Whether the latest data of any table came from the cache."""
    return status.agg(F.coalesce(F.bool_or(F.col("data_source") == "cached"), F.lit(False)).alias("using_cached_data"))


def total_records(table: DataFrame) -> DataFrame:
    """Rows in the table, which after upserts is not the sum over runs."""
    return table.agg(F.count(F.lit(1)).alias("total"))


def incident_summary(incidents: DataFrame) -> DataFrame:
    """Incident counts and the share of approved ones among those decided."""
    counts = incidents.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("fix_result") == "auto_approved").alias("auto_resolved"),
        F.count_if(F.col("fix_result") == "escalated").alias("escalated"),
        F.count_if(F.col("approved").isNotNull()).alias("decided"),
        F.count_if("approved").alias("approved_count"),
    )
    return counts.select("total", "auto_resolved", "escalated",
                         percent(F.col("approved_count"), F.col("decided")).alias("fix_success_rate"))


def latest_incident(incidents: DataFrame, tiebreak: Sequence[Column] = ()) -> DataFrame:
    """The newest incident, labelled, with its root cause cut to 300 characters."""
    last = newest(incidents, [F.desc_nulls_last("created_at"), *tiebreak])
    return last.select(
        "task_id", F.coalesce(F.nullif("error_type", F.lit("")), F.lit("unknown_error")).alias("error_type"),
        labels.decision_label(F.col("fix_result")).alias("decision"),
        labels.shorten(labels.or_dash(F.col("error_message")), 300, 300).alias("root_cause"),
        labels.or_dash(F.col("fix_attempted")).alias("action"), "fix_sql",
        local_time(F.col("created_at")).alias("created_local"), "created_at",
    )


def incident_history(incidents: DataFrame, n: int = 10, tiebreak: Sequence[Column] = ()) -> DataFrame:
    """The ``n`` newest incidents, labelled, with the action cut to 60 characters."""
    recent = newest(incidents, [F.desc_nulls_last("created_at"), *tiebreak], n)
    return recent.select(
        "created_at", local_time(F.col("created_at"), "MM/dd hh:mm a").alias("time"), "task_id",
        labels.or_dash(F.col("error_type")).alias("error_type"),
        labels.decision_label(F.col("fix_result")).alias("decision"),
        labels.shorten(labels.or_dash(F.col("fix_attempted")), 60, 57).alias("action"),
    )


def top_drugs(reactions: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` drugs with most reports over all reactions, with their share of the leader's volume."""
    totals = reactions.where(F.col("drug_name").isNotNull()).groupBy("drug_name").agg(
        F.sum("report_count").alias("total_reports"),
        F.sum("serious_count").alias("total_serious"),
        F.sum("fatal_count").alias("total_fatal"),
    )
    top = newest(totals, [F.desc("total_reports"), F.asc("drug_name")], n)
    leader = F.max("total_reports").over(Window.partitionBy())  # over the n rows that are left
    return top.withColumn("share_of_top", F.round(F.col("total_reports") / leader * 100, 1))
