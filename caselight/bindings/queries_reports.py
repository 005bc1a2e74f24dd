"""Staging, marts, quality and reporting queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from caselight.bindings import inputs as b
from caselight.bindings.ctes import day, staged, stamp
from caselight.bindings.registry import query
from caselight.functions import labels
from caselight.functions.measures import percent
from caselight.operators import quality, runlog
from caselight.operators.changes import dedupe_batch
from caselight.plans import marts, reports, staging

STAGED_OUT = f"""
report_id, {day('received_date')} AS received_date, serious::VARCHAR AS serious, serious_death::VARCHAR AS serious_death,
serious_hosp::VARCHAR AS serious_hosp, serious_life::VARCHAR AS serious_life, patient_age, patient_age_unit, patient_sex,
drug_name, drug_indication, reaction, outcome, country, is_serious::VARCHAR AS is_serious, is_fatal::VARCHAR AS is_fatal,
{stamp('loaded_at')} AS loaded_at, {day('load_date')} AS load_date
"""


# --- staging and marts -----------------------------------------------------------------------------------------------

@query("stage_reports", f", s AS ({staged('x_raw')}) SELECT {STAGED_OUT} FROM s")
def stage_reports(spark, sf):
    return staging.stage_reports(b.raw_reports(spark, sf))


@query("load_reports", f"SELECT {STAGED_OUT} FROM x_staged")
def load_reports(spark, sf):
    return staging.stage_reports(b.loaded_reports(spark, sf))


@query("normalize_codes", f"""
, floats AS (
    SELECT * REPLACE (CASE WHEN serious IS NULL THEN 'NaN' ELSE serious || '.0' END AS serious,
                      coalesce(serious_death || '.0', 'nan') AS serious_death) FROM x_raw),
fixed AS (
    SELECT report_id, source_row,
           nullif(replace(serious, '.0', ''), 'NaN') AS serious,
           nullif(replace(serious_death, '.0', ''), 'nan') AS serious_death,
           nullif(trim(serious_hosp), '') AS serious_hosp FROM floats)
SELECT report_id, source_row, serious, serious_death, serious_hosp, coalesce(serious = '1', FALSE)::VARCHAR AS is_serious,
       coalesce(serious_death = '1', FALSE)::VARCHAR AS is_fatal FROM fixed
""")
def normalize_codes(spark, sf):
    """Codes as a dataframe library writes them when a column has missing values, brought back to plain codes."""
    raw = b.raw_reports(spark, sf, reporter=False)
    floats = raw.withColumns({
        "serious": F.coalesce(F.concat("serious", F.lit(".0")), F.lit("NaN")),
        "serious_death": F.coalesce(F.concat("serious_death", F.lit(".0")), F.lit("nan")),
    })
    clean = staging.normalize_codes(floats, ["serious", "serious_death", "serious_hosp"])
    return clean.select(
        "report_id", "source_row", "serious", "serious_death", "serious_hosp",
        staging.strict_flag(F.col("serious")).alias("is_serious"),
        staging.strict_flag(F.col("serious_death")).alias("is_fatal"),
    )


def _staged_for(spark, sf, columns):
    raw = b.raw_reports(spark, sf, reporter=False)
    return staging.stage_reports(dedupe_batch(raw, ["report_id"], b.last_wins()), columns)


@query("mart_drug_reactions", f"SELECT * REPLACE ({day('most_recent_report_date')} AS most_recent_report_date) FROM x_reactions")
def mart_drug_reactions(spark, sf):
    return marts.drug_reactions(_staged_for(spark, sf, marts.REACTION_INPUTS))


@query("mart_serious_events", f"""
, pairs AS (
    SELECT drug_name, outcome, count(*) AS report_count, count(*) FILTER (WHERE is_fatal) AS fatal_count,
           round(avg(patient_age), 1) AS avg_patient_age, {day('max(received_date)')} AS most_recent_date
    FROM x_staged WHERE is_serious GROUP BY ALL),
ranked AS (SELECT *, rank() OVER (PARTITION BY drug_name ORDER BY report_count DESC) AS severity_rank FROM pairs)
SELECT * FROM ranked WHERE report_count > 5
""")
def mart_serious_events(spark, sf):
    return marts.serious_events(_staged_for(spark, sf, marts.SERIOUS_INPUTS))


@query("top_drugs", """
, totals AS (
    SELECT drug_name, sum(report_count)::BIGINT AS total_reports, sum(serious_count)::BIGINT AS total_serious,
           sum(fatal_count)::BIGINT AS total_fatal
    FROM x_reactions WHERE drug_name IS NOT NULL GROUP BY drug_name ORDER BY total_reports DESC, drug_name LIMIT 10)
SELECT *, round(total_reports / (SELECT max(total_reports) FROM totals) * 100, 1) AS share_of_top FROM totals
""")
def top_drugs(spark, sf):
    return reports.top_drugs(marts.drug_reactions(_staged_for(spark, sf, marts.REACTION_INPUTS)))


@query("total_records", "SELECT count(*) AS total FROM x_loaded")
def total_records(spark, sf):
    return reports.total_records(b.loaded_reports(spark, sf, reporter=False))


# --- quality ---------------------------------------------------------------------------------------------------------

@query("dq_rules", """
, bad AS (SELECT * REPLACE (CASE WHEN patient_sex = '1' AND serious_hosp IS DISTINCT FROM '2' THEN '1.0' ELSE patient_sex END
                            AS patient_sex) FROM x_raw),
r(column_name, rule, failures) AS (
    SELECT 'report_id', 'not_null', count(*) FILTER (WHERE report_id IS NULL) FROM bad UNION ALL
    SELECT 'drug_name', 'not_null', count(*) FILTER (WHERE drug_name IS NULL) FROM bad UNION ALL
    SELECT 'reaction', 'not_null', count(*) FILTER (WHERE reaction IS NULL) FROM bad UNION ALL
    SELECT 'patient_sex', 'accepted_values', count(*) FILTER (WHERE patient_sex NOT IN ('1', '2')) FROM bad UNION ALL
    SELECT 'report_id', 'unique', count(*) FROM (SELECT report_id FROM bad GROUP BY 1 HAVING count(*) > 1))
SELECT 'stg_reports' AS table_name, column_name, rule, failures, (failures = 0)::VARCHAR AS passed FROM r
""")
def dq_rules(spark, sf):
    raw = b.raw_reports(spark, sf)
    odd = (F.col("patient_sex") == "1") & ~F.col("serious_hosp").eqNullSafe("2")
    staged_rows = staging.stage_reports(raw.withColumn("patient_sex", F.when(odd, "1.0").otherwise(F.col("patient_sex"))),
                                        ["report_id", "drug_name", "reaction", "patient_sex"])
    return quality.run_rules(staged_rows, quality.STAGED_RULES, "stg_reports")


@query("dq_rules_excluding", """
SELECT 'stg_reports' AS table_name, 'drug_name' AS column_name, 'not_null' AS rule,
       count(*) FILTER (WHERE drug_name IS NULL) AS failures, (failures = 0)::VARCHAR AS passed FROM x_raw
UNION ALL
SELECT 'stg_reports', 'patient_sex', 'accepted_values', count(*) FILTER (WHERE patient_sex NOT IN ('1', '2')),
       (count(*) FILTER (WHERE patient_sex NOT IN ('1', '2')) = 0)::VARCHAR FROM x_raw
""")
def dq_rules_excluding(spark, sf):
    staged_rows = staging.stage_reports(b.raw_reports(spark, sf), ["report_id", "drug_name", "reaction", "patient_sex"])
    return quality.run_rules(staged_rows, quality.STAGED_RULES, "stg_reports",
                             exclude=["not_null_report_id", "unique_report_id", "not_null_reaction"])


@query("duplicate_keys", "SELECT report_id, count(*) AS n_rows FROM x_raw GROUP BY report_id HAVING n_rows > 1")
def duplicate_keys(spark, sf):
    return quality.duplicate_keys(b.raw_reports(spark, sf, reporter=False), ["report_id"])


NULLABLE = ["serious", "serious_death", "serious_hosp", "serious_life", "drug_name", "reaction"]


@query("null_rates", " UNION ALL ".join(f"""
SELECT '{c}' AS column_name, count(*) AS total_rows, count(*) - count({c}) AS null_rows,
       round((count(*) - count({c})) / count(*) * 100, 2) AS null_pct FROM x_raw""" for c in NULLABLE))
def null_rates(spark, sf):
    return quality.null_rates(b.raw_reports(spark, sf, reporter=False), NULLABLE)


@query("null_rates_by_table", """
SELECT schema_name, table_name, 'value' AS column_name, count(*) AS total_rows,
       count(*) FILTER (WHERE value < 10) AS null_rows, round(null_rows / total_rows * 100, 2) AS null_pct
FROM x_tracked GROUP BY ALL
""")
def null_rates_by_table(spark, sf):
    """One scan gives the null rate of a column in each of several tables."""
    rows = b.tracked_events(spark, sf).withColumn("value", F.when(F.col("value") >= 10, F.col("value")))
    return quality.null_rates(rows, ["value"], by=["schema_name", "table_name"])


LENGTHS = {"report_id": 6, "drug_name": 20, "reaction": 8, "serious_life": 2}


@query("length_limits", " UNION ALL ".join(f"""
SELECT 'raw_reports' AS table_name, '{c}' AS column_name, 'max_length' AS rule,
       count(*) FILTER (WHERE length({c}) > {n}) AS failures, (failures = 0)::VARCHAR AS passed FROM x_raw"""
       for c, n in LENGTHS.items()))
def length_limits(spark, sf):
    rules = [quality.max_length(column, limit) for column, limit in LENGTHS.items()]
    return quality.run_rules(b.raw_reports(spark, sf, reporter=False), rules, "raw_reports")


@query("quarantine", """
, broken AS (SELECT report_id, source_row, drug_name, serious,
                    CASE WHEN source_row % 7 = 0 THEN '20241345' ELSE received_date END AS received_date FROM x_raw)
SELECT report_id, source_row, concat_ws(',', CASE WHEN drug_name IS NULL THEN 'not_null_drug_name' END,
           CASE WHEN received_date = '20241345' THEN 'valid_day_received_date' END) AS failed_rules
FROM broken WHERE failed_rules <> ''
""")
def quarantine(spark, sf):
    """Rows a load would set aside: no drug name, or a date that is none."""
    raw = b.raw_reports(spark, sf, reporter=False)
    broken = raw.withColumn("received_date", F.when(F.col("source_row") % 7 == 0, "20241345").otherwise(F.col("received_date")))
    rules = [quality.not_null("drug_name"), quality.valid_day("received_date")]
    return quality.quarantine(broken, rules)[1].select("report_id", "source_row", "failed_rules")


# --- run reports -----------------------------------------------------------------------------------------------------

@query("run_summary", f"""
SELECT count(*) AS total_runs, round(sum(ok::INT) / count(*) * 100, 6) AS success_rate, {stamp('max(started)')} AS last_run_at
FROM (SELECT run_id, bool_and(status = 'success') AS ok, min(started_at) AS started FROM x_runs GROUP BY run_id)
""")
def run_summary(spark, sf):
    return reports.run_summary(b.task_runs(spark, sf)).withColumn("success_rate", F.round("success_rate", 6))


DURATION = """
CASE WHEN finished_at IS NULL OR started_at IS NULL THEN '—'
     WHEN epoch(finished_at - started_at) < 60 THEN floor(epoch(finished_at - started_at))::BIGINT || 's'
     ELSE printf('%dm %02ds', floor(epoch(finished_at - started_at))::BIGINT // 60,
                 floor(epoch(finished_at - started_at))::BIGINT % 60) END
"""
HEALING = "SELECT run_id, task_id FROM x_incidents WHERE fix_result IN ('auto_approved', 'approved')"


@query("run_stages", f"""
SELECT r.run_id, r.task_id, r.status, r.rows_processed, r.error_message, {stamp('started_at')} AS started_at,
       {stamp('finished_at')} AS finished_at, ((r.run_id, r.task_id) IN ({HEALING}))::VARCHAR AS healed,
       CASE WHEN (r.run_id, r.task_id) IN ({HEALING}) THEN 'AI Healed' WHEN status = 'failed' THEN 'Failed'
            WHEN status = 'success' THEN 'Success' ELSE 'Running' END AS stage_label,
       {DURATION} AS duration
FROM x_runs r
""")
def run_stages(spark, sf):
    """Stage states of every run."""
    runs = b.task_runs(spark, sf)
    stages = reports.run_stages(runs, b.incident_reports(spark, sf), runs.select("run_id").distinct())
    seconds = reports.seconds_between(F.col("started_at"), F.col("finished_at"))
    return stages.drop("dag_id").withColumns({
        "stage_label": labels.stage_label(F.col("status"), F.col("healed")), "duration": labels.duration_label(seconds),
    })


@query("latest_run_stages", f"""
, latest AS (SELECT run_id FROM x_runs ORDER BY started_at DESC, run_id DESC LIMIT 1),
s AS (SELECT * FROM x_runs WHERE run_id = (SELECT run_id FROM latest)),
plan(position, task_id, task) AS (VALUES (0, 'check_drill', 'Check Drill'), (1, 'extract_reports', 'Extract Reports'),
    (2, 'validate_schema', 'Validate Schema'), (3, 'load_reports', 'Load Reports'), (4, 'build_models', 'Build Models')),
j AS (SELECT position::BIGINT AS position, plan.task_id, task, status, rows_processed, error_message, started_at, finished_at,
             CASE WHEN status IS NOT NULL THEN (s.run_id, s.task_id) IN ({HEALING}) END AS healed
      FROM plan LEFT JOIN s USING (task_id))
SELECT * REPLACE (healed::VARCHAR AS healed, {stamp('started_at')} AS started_at, {stamp('finished_at')} AS finished_at),
       CASE WHEN status IS NULL THEN 'Skipped' WHEN healed THEN 'AI Healed' WHEN status = 'failed' THEN 'Failed'
            WHEN status = 'success' THEN 'Success' ELSE 'Running' END AS stage_label,
       CASE WHEN healed OR status <> 'running' THEN {DURATION} ELSE '—' END AS duration
FROM j
""")
def latest_run_stages(spark, sf):
    return reports.latest_run_stages(b.task_runs(spark, sf), b.incident_reports(spark, sf))


RUN_STATES = f"""
, states AS (
    SELECT run_id, dag_id, bool_and(status = 'success') AS all_success, bool_or(status = 'failed') AS any_failed,
           min(started_at) AS started_at, max(finished_at) AS finished_at,
           max(rows_processed) FILTER (WHERE task_id = 'load_reports') AS records
    FROM x_runs GROUP BY ALL),
labelled AS (
    SELECT run_id, dag_id, all_success::VARCHAR AS all_success, any_failed::VARCHAR AS any_failed,
           {stamp('started_at')} AS started_at, {stamp('finished_at')} AS finished_at, records, h::VARCHAR AS healed,
           CASE WHEN h THEN 'Healed by AI' WHEN any_failed THEN 'Failed' WHEN all_success THEN 'Success' ELSE 'Running' END
               AS status, {DURATION} AS duration
    FROM (SELECT *, run_id IN (SELECT run_id FROM ({HEALING})) AS h FROM states))
"""


@query("run_history", RUN_STATES + "SELECT * FROM labelled")
def run_history(spark, sf):
    """State of every run."""
    return reports.labelled_runs(reports.run_states(b.task_runs(spark, sf)), b.incident_reports(spark, sf))


@query("recent_runs", RUN_STATES + "SELECT * FROM labelled ORDER BY started_at DESC, run_id DESC LIMIT 10")
def recent_runs(spark, sf):
    return reports.recent_runs(b.task_runs(spark, sf), b.incident_reports(spark, sf))


@query("unhealed_failures", f"""
SELECT run_id, task_id, {stamp('finished_at')} AS finished_at, coalesce(error_message, '(no error message recorded)') AS error_message
FROM x_runs WHERE status = 'failed' AND (run_id, task_id) NOT IN ({HEALING})
""")
def unhealed_failures(spark, sf):
    runs = b.task_runs(spark, sf)
    failed = runs.where(F.col("status") == "failed")
    stages = reports.run_stages(failed, b.incident_reports(spark, sf), failed.select("run_id").distinct())
    return reports.unhealed_failures(stages).select("run_id", "task_id", "finished_at", "error_message")


@query("run_log_fold", f"""
SELECT dag_id, run_id, task_id, status, CASE WHEN status <> 'running' THEN rows_processed END AS rows_processed, error_message,
       {stamp('started_at')} AS started_at, {stamp('finished_at')} AS finished_at FROM x_runs
""")
def run_log_fold(spark, sf):
    """Start and finish events of every task run, folded back into one row."""
    runs = b.task_runs(spark, sf)
    done = runs.where(F.col("status") != "running")
    started = runlog.start_events(runs, F.col("started_at"))
    finished = runlog.finish_events(done, F.col("started_at"), F.col("finished_at"))
    early = finished.withColumns({"status": F.lit("running"), "finished_at": F.col("finished_at") - F.expr("interval 1 hour")})
    return runlog.fold(started.unionByName(early).unionByName(finished))


@query("freshness_latest", f"""
SELECT table_name, schema_name, {stamp('last_loaded')} AS last_loaded, is_stale::VARCHAR AS is_stale, data_source
FROM x_freshness_status
""")
def freshness_latest(spark, sf):
    return reports.freshness_status(b.freshness_checks(spark, sf))


@query("using_cached_data", "SELECT coalesce(bool_or(data_source = 'cached'), FALSE)::VARCHAR AS using_cached_data FROM x_freshness_status")
def using_cached_data(spark, sf):
    return reports.uses_cache(reports.freshness_status(b.freshness_checks(spark, sf)))


@query("incident_summary", """
SELECT count(*) AS total, count(*) FILTER (WHERE fix_result = 'auto_approved') AS auto_resolved,
       count(*) FILTER (WHERE fix_result = 'escalated') AS escalated,
       round(sum(approved::INT) / count(approved) * 100, 6) AS fix_success_rate FROM x_incidents
""")
def incident_summary(spark, sf):
    return reports.incident_summary(b.incident_reports(spark, sf)).withColumn(
        "fix_success_rate", F.round("fix_success_rate", 6))


@query("incident_summary_by_type", """
SELECT error_type, count(*) AS total, count(approved) AS decided, count(*) FILTER (WHERE approved) AS approved_count,
       round(approved_count / nullif(decided, 0) * 100, 6) AS fix_success_rate FROM x_incidents GROUP BY error_type
""")
def incident_summary_by_type(spark, sf):
    grouped = b.incident_reports(spark, sf).groupBy("error_type").agg(
        F.count(F.lit(1)).alias("total"), F.count("approved").alias("decided"), F.count_if("approved").alias("approved_count"))
    return grouped.withColumn("fix_success_rate", F.round(percent(F.col("approved_count"), F.col("decided")), 6))


DECISION = """
CASE fix_result WHEN 'auto_approved' THEN 'Auto-Resolved' WHEN 'approved' THEN 'Approved' WHEN 'rejected' THEN 'Rejected'
     WHEN 'escalated' THEN 'Escalated' WHEN 'pending' THEN 'Pending' ELSE coalesce(fix_result, 'Unknown') END
"""
# The test data lies in January, when the zone is five hours behind.
LOCAL = "created_at - INTERVAL 5 HOURS"


@query("latest_incident", f"""
SELECT task_id, error_type, {DECISION} AS decision,
       CASE WHEN length(error_message) > 300 THEN error_message[:300] || '…' ELSE error_message END AS root_cause,
       coalesce(fix_attempted, '—') AS action, fix_sql, strftime({LOCAL}, '%Y-%m-%d %I:%M %p') AS created_local,
       {stamp('created_at')} AS created_at
FROM x_incidents ORDER BY x_incidents.created_at DESC, event_id DESC LIMIT 1
""")
def latest_incident(spark, sf):
    return reports.latest_incident(b.incident_reports(spark, sf), [F.desc("event_id")])


HISTORY = f"""
, h AS (SELECT *, strftime({LOCAL}, '%m/%d %I:%M %p') AS time, {DECISION} AS decision,
               CASE WHEN length(fix_attempted) > 60 THEN fix_attempted[:57] || '…' ELSE coalesce(fix_attempted, '—') END AS action
        FROM x_incidents)
"""


@query("incident_history", HISTORY + f"""
SELECT {stamp('created_at')} AS created_at, time, task_id, error_type, decision, action
FROM h ORDER BY h.created_at DESC, event_id DESC LIMIT 10
""")
def incident_history(spark, sf):
    return reports.incident_history(b.incident_reports(spark, sf), 10, [F.desc("event_id")])


@query("incident_labels", HISTORY + "SELECT event_id, time, decision, action FROM h")
def incident_labels(spark, sf):
    """Decision label, local time and shortened action of every incident."""
    return b.incident_reports(spark, sf).select(
        "event_id", reports.local_time(F.col("created_at"), "MM/dd hh:mm a").alias("time"),
        labels.decision_label(F.col("fix_result")).alias("decision"),
        labels.shorten(labels.or_dash(F.col("fix_attempted")), 60, 57).alias("action"),
    )
