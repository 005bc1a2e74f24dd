"""Task runs as events: a start row, later a finish row, folded to one row per attempt."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from caselight.functions.measures import moment

RUN_KEY = ["dag_id", "run_id", "task_id"]


def start_events(runs: DataFrame, at) -> DataFrame:
    """One ``running`` event per (dag_id, run_id, task_id) row."""
    return runs.select(
        *RUN_KEY,
        F.lit("running").alias("status"),
        F.lit(None).cast("bigint").alias("rows_processed"),
        F.lit(None).cast("string").alias("error_message"),
        moment(at).alias("started_at"),
        F.lit(None).cast("timestamp_ntz").alias("finished_at"),
    )


def finish_events(results: DataFrame, started_at, at) -> DataFrame:
    """Finish events of the attempts that started at ``started_at``, from rows with the run key, status,
    rows_processed and error_message."""
    return results.select(
        *RUN_KEY, "status", F.col("rows_processed").cast("bigint").alias("rows_processed"), "error_message",
        moment(started_at).alias("started_at"), moment(at).alias("finished_at"),
    )


def fold(events: DataFrame) -> DataFrame:
    """One row per attempt, which is a task of a run and its start time: the values of its newest finish event.

    One aggregate by key; each map task merges the events of an attempt before the shuffle.
    """
    finish = F.when(F.col("finished_at").isNotNull(), F.struct("finished_at", "status", "rows_processed", "error_message"))
    state = events.groupBy(*RUN_KEY, "started_at").agg(F.max(finish).alias("finish"))
    return state.select(
        *RUN_KEY,
        F.coalesce("finish.status", F.lit("running")).alias("status"),
        F.col("finish.rows_processed").alias("rows_processed"),
        F.col("finish.error_message").alias("error_message"),
        "started_at",
        F.col("finish.finished_at").alias("finished_at"),
    )
