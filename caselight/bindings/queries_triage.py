"""Incident triage, statement audit, approvals, lineage and similarity."""

from __future__ import annotations

from pyspark.sql import functions as F

from caselight.bindings import inputs as b
from caselight.bindings.ctes import hint, q, severity, stamp
from caselight.bindings.queries_monitors import APPROVAL_OUT
from caselight.bindings.registry import query
from caselight.bindings.texts import AS_OF, STATEMENTS
from caselight.functions import logs
from caselight.functions.statements import ALLOWED_TABLES
from caselight.operators import approvals, incidents, lineage, similarity
from caselight.operators.audit import audit
from caselight.operators.repair import rename_candidates
from caselight.plans import triage
from caselight.plans.ingest import Warehouse
from caselight.session import shared_dir
from caselight.streaming import records

REUSE_SCORE = 0.38  # the vectors of the test data are nearly orthogonal


# --- logs and severity -----------------------------------------------------------------------------------------------

@query("log_backfill", "SELECT incident_id, raw_log FROM x_backfilled")
def log_backfill(spark, sf):
    return incidents.backfill_logs(b.alerts(spark, sf), b.task_runs(spark, sf)).select("incident_id", "raw_log")


@query("log_parse", "SELECT incident_id, task_id, error_message, error_type_hint, raw_log FROM x_parsed")
def log_parse(spark, sf):
    parsed = incidents.parse_logs(incidents.backfill_logs(b.alerts(spark, sf), b.task_runs(spark, sf)))
    return parsed.select("incident_id", "task_id", "error_message", "error_type_hint", "raw_log")


@query("document_hints", f"""
SELECT doc_id, {hint("m")} AS error_type_hint, md5(m) AS message_digest
FROM (SELECT doc_id, regexp_replace(CASE WHEN contains(text, 'Traceback (most recent call last):')
             THEN list_filter(string_split(text, chr(10)), lambda line: trim(line) <> '')[-1] ELSE text END,
             '^\\s+|\\s+$', '', 'g') AS m FROM documents)
""")
def document_hints(spark, sf):
    """The log parser over long free texts, whole."""
    message = logs.error_message(F.col("text"))
    return b.table(spark, sf, "documents").select(
        "doc_id", logs.error_type_hint(message).alias("error_type_hint"), F.md5(message).alias("message_digest"))


@query("severity", "SELECT incident_id, label, error_type_hint, error_type, severity FROM x_classified")
def severity_of_alerts(spark, sf):
    parsed = incidents.parse_logs(incidents.backfill_logs(b.alerts(spark, sf), b.task_runs(spark, sf)))
    return incidents.classify(parsed, "label").select("incident_id", "label", "error_type_hint", "error_type", "severity")


# --- statements ------------------------------------------------------------------------------------------------------

@query("statement_audit", f"""
SELECT event_id, sql, tier, reason, statement_type, array_to_string(tables, ',') AS tables
FROM events JOIN x_audited ON n = event_id % {len(STATEMENTS)}
""")
def statement_audit(spark, sf):
    statements = b.table(spark, sf, "events").select("event_id", b._statement("event_id").alias("sql"))
    return audit(statements).select("event_id", "sql", "audit.*")


# --- lineage ---------------------------------------------------------------------------------------------------------

REACH = """/* recursive */
, reach(root, node) AS (
    SELECT r.root, child FROM (SELECT DISTINCT root FROM x_sources) r JOIN x_edges ON parent = r.root
    UNION
    SELECT root, child FROM reach JOIN x_edges ON parent = node)
"""
MODELS = """(SELECT *, lower(CASE WHEN raw_code <> '' THEN raw_code ELSE coalesce(compiled_code, '') END) AS code FROM x_nodes
                 WHERE resource_type = 'model')"""


@query("lineage_downstream", """/* recursive */
, reach(root, node) AS (
    SELECT r.root, child FROM (SELECT DISTINCT (event_id - 1) // 2 AS root FROM x_tracked WHERE event_id > 0) r JOIN x_edges ON parent = r.root
    UNION
    SELECT root, child FROM reach JOIN x_edges ON parent = node)
SELECT root::BIGINT AS root, node FROM reach
""")
def lineage_downstream(spark, sf):
    """What the monitored tables feed; a table stands above every event it got, not only the last."""
    got = b.tracked_events(spark, sf).where("event_id > 0")
    roots = got.select(F.floor((F.col("event_id") - 1) / 2).alias("root")).distinct()
    return lineage.downstream(b.lineage_edges(spark, sf), roots)


@query("impacted_models", REACH + f"""
SELECT root::BIGINT AS root, name, column_name, coalesce(contains(code, lower(column_name)), FALSE)::VARCHAR AS references_column
FROM reach JOIN {MODELS} ON unique_id = node JOIN (SELECT DISTINCT root, column_name FROM x_drift) c USING (root)
""")
def impacted_models(spark, sf):
    """Models below each table that drifted, and whether they mention the column that changed there."""
    changed = b.drift(spark, sf).select("root", "column_name").distinct()
    return lineage.impacted_models(b.lineage_edges(spark, sf), b.lineage_nodes(spark, sf), changed)


@query("impacted_by_table", REACH + f"""
SELECT schema_name, table_name, array_to_string(list(DISTINCT name ORDER BY name), ',') AS models,
       array_to_string(coalesce(list(DISTINCT name ORDER BY name) FILTER (contains(code, lower(column_name))), []), ',') AS referencing
FROM x_drift JOIN reach USING (root) JOIN {MODELS} ON unique_id = node GROUP BY schema_name, table_name
""")
def impacted_by_table(spark, sf):
    return lineage.impact_by_table(b.lineage_edges(spark, sf), b.lineage_nodes(spark, sf), b.drift(spark, sf))


REACH_ALL = """/* recursive */
, reach(root, node) AS (
    SELECT parent, child FROM x_edges
    UNION
    SELECT root, child FROM reach JOIN x_edges ON parent = node)
"""


@query("lineage_all_sources", REACH_ALL + "SELECT root::BIGINT AS root, node FROM reach")
def lineage_all_sources(spark, sf):
    """Descendants of every node that feeds another one."""
    return lineage.Reach.of(b.lineage_edges(spark, sf)).pairs()


@query("lineage_classes", REACH_ALL + """
, sets AS (SELECT root, count(*) AS n_reached, list(node ORDER BY node) AS reached FROM reach GROUP BY root)
SELECT root::BIGINT AS root, min(root) OVER same::BIGINT AS class_id, count(*) OVER same AS class_size, n_reached
FROM sets WINDOW same AS (PARTITION BY reached)
""")
def lineage_classes(spark, sf):
    """How many nodes every node that feeds another one reaches, and which of them reach the same."""
    return lineage.Reach.of(b.lineage_edges(spark, sf)).classes().withColumnRenamed("node", "root")


CHANGES = "(SELECT event_id AS root, CASE WHEN event_id % 7 <> 0 THEN event_type || '_id' END AS column_name FROM events)"


def _changes(spark, sf):
    column = F.when(F.col("event_id") % 7 != 0, F.concat("event_type", F.lit("_id")))
    return b.table(spark, sf, "events").select(F.col("event_id").alias("root"), column.alias("column_name"))


@query("impacted_all_sources", REACH_ALL + f"""
SELECT root::BIGINT AS root, name, column_name, coalesce(contains(code, lower(column_name)), FALSE)::VARCHAR AS references_column
FROM reach JOIN {MODELS} ON unique_id = node JOIN {CHANGES} c USING (root)
""")
def impacted_all_sources(spark, sf):
    """Impacted models of every node that feeds another one, each with the column of its own row as the changed one."""
    return lineage.Reach.of(b.lineage_edges(spark, sf)).impacted(b.lineage_nodes(spark, sf), _changes(spark, sf))


@query("impact_counts", REACH_ALL + f"""
SELECT c.root::BIGINT AS root, c.column_name, count(code) AS n_models,
       count(*) FILTER (contains(code, lower(c.column_name))) AS n_referencing
FROM reach JOIN {CHANGES} c USING (root)
LEFT JOIN {MODELS} ON unique_id = node GROUP BY c.root, c.column_name
""")
def impact_counts(spark, sf):
    """How many models lie below every node that feeds another one, and how many mention the column of its own row."""
    return lineage.Reach.of(b.lineage_edges(spark, sf)).impact(b.lineage_nodes(spark, sf), _changes(spark, sf))


@query("source_lookup", """
SELECT event_type AS source_name, 'user_' || user_id AS name, min(event_id) FILTER (WHERE value > 200) AS unique_id,
       (unique_id IS NOT NULL)::VARCHAR AS source_found
FROM events GROUP BY event_type, user_id
""")
def source_lookup(spark, sf):
    """Sources asked for by name, not all of which are in the list."""
    events = b.table(spark, sf, "events").withColumn("name", F.concat(F.lit("user_"), F.col("user_id").cast("string")))
    wanted = events.select(F.col("event_type").alias("source_name"), "name").distinct()
    known = events.where(F.col("value") > 200).groupBy(F.col("event_type").alias("source_name"), "name").agg(
        F.min("event_id").alias("unique_id"))
    return lineage.source_ids(known, wanted)


# --- similarity ------------------------------------------------------------------------------------------------------

SIMILAR = """
, s AS (SELECT query_id, match_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, match_id) AS rank FROM x_scores)
"""
REUSABLE = f"""
, r AS (SELECT query_id, match_id, score FROM x_scores WHERE has_sql_fix
        QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, match_id) = 1 AND score >= {REUSE_SCORE})
"""


@query("similar_incidents", SIMILAR + "SELECT query_id, match_id, round(score, 6) AS score, rank FROM s WHERE rank <= 3")
def similar_incidents(spark, sf):
    """For every incident the three most similar earlier ones."""
    memory = b.incident_vectors(spark, sf)
    found = similarity.nearest(memory, memory, 3, order="incident_id")
    return found.withColumn("score", F.round("score", 6))


@query("reusable_fix", REUSABLE + "SELECT query_id, match_id, round(score, 6) AS score FROM r")
def reusable_fix(spark, sf):
    memory = b.incident_vectors(spark, sf)
    found = similarity.reusable_fixes(memory, memory, REUSE_SCORE, order="incident_id")
    return found.withColumn("score", F.round("score", 6))


# --- evidence, fix, routing, records ---------------------------------------------------------------------------------

def _evidence_inputs(spark, sf):
    memory = b.incident_vectors(spark, sf)
    nulls = b.tracked_events(spark, sf).withColumn("drug_name", F.when(F.col("value") >= 10, F.col("value")))
    return {
        "similar": similarity.nearest(memory, memory, 3, order="incident_id"),
        "memory": memory,
        "live": b.live_columns(spark, sf),
        "snapshots": b.snapshots(spark, sf),
        "stats": b.tracked_stats(spark, sf),
        "baselines": b.baselines(spark, sf),
        "rows": nulls,
        "freshness": b.freshness_checks(spark, sf),
        "impact": lineage.impact_by_table(b.lineage_edges(spark, sf), b.lineage_nodes(spark, sf), b.drift(spark, sf)),
    }


def _classified(spark, sf):
    parsed = incidents.parse_logs(incidents.backfill_logs(b.alerts(spark, sf), b.task_runs(spark, sf)))
    return incidents.classify(parsed, "label")


EVIDENCE = SIMILAR + REACH + """
, near AS (SELECT query_id AS incident_id, count(*) AS n_similar, max(score) AS top_score,
                  'incident ' || max(match_id) FILTER (WHERE rank = 1) AS top_summary
           FROM s WHERE rank <= 3 GROUP BY query_id),
nulls AS (SELECT schema_name, table_name, count(*) FILTER (WHERE value < 10) AS nn, count(*) AS total,
                 round(nn / total * 100, 2) AS pct FROM x_tracked GROUP BY ALL),
impact AS (SELECT schema_name, table_name, list(DISTINCT name ORDER BY name) AS models,
                  list(DISTINCT name ORDER BY name) FILTER (contains(code, lower(column_name))) AS referencing
           FROM x_drift JOIN reach USING (root) JOIN """ + MODELS + """ ON unique_id = node GROUP BY schema_name, table_name),
j AS (SELECT c.*, n_similar, top_score, top_summary,
             list_transform(coalesce(d.added, []), lambda x: '''' || x || '''') AS a,
             list_transform(CASE WHEN has_prior_snapshot THEN coalesce(d.removed, []) ELSE [] END, lambda x: '''' || x || '''') AS r,
             list_transform(CASE WHEN has_prior_snapshot THEN coalesce(d.changed_types, []) ELSE [] END, lambda x: '''' || x || '''') AS t,
             list_transform(models, lambda x: '''' || x || '''') AS models, models AS model_names,
             list_transform(referencing, lambda x: '''' || x || '''') AS referencing,
             CASE WHEN impact.models IS NOT NULL THEN coalesce(referencing, []) END AS referencing_names,
             current_count, baseline_count, deviation_pct, nn, total, pct, f.table_name AS fresh, last_loaded, is_stale,
             CASE WHEN error_type = 'schema_drift' AND len(a) = 1 AND len(r) = 1 THEN d.removed[1] END AS changed_column
      FROM x_classified c LEFT JOIN near USING (incident_id) LEFT JOIN x_diff d USING (schema_name, table_name)
      LEFT JOIN x_counts USING (schema_name, table_name) LEFT JOIN nulls USING (schema_name, table_name)
      LEFT JOIN impact USING (schema_name, table_name) LEFT JOIN x_freshness_status f USING (schema_name, table_name)),
texts AS (SELECT *,
    CASE WHEN n_similar > 0 THEN printf('Found %d similar past incident(s); most similar (score %.2f): %s.', n_similar,
        round(top_score, 2), top_summary) ELSE 'No similar past incidents found in memory.' END AS t_memory,
    'Columns against the last snapshot: new [' || array_to_string(a, ', ') || '], gone [' || array_to_string(r, ', ')
        || '], other type or nullability [' || array_to_string(t, ', ') || ']. Models below the table: [' || array_to_string(coalesce(models, []), ', ') || ']'
        || CASE WHEN changed_column IS NOT NULL THEN '; models referencing the changed column: ['
               || array_to_string(coalesce(referencing, []), ', ') || ']' ELSE '' END || '.' AS t_drift,
    'Row count check: current=' || coalesce(current_count::VARCHAR, 'None') || ' baseline='
        || coalesce(baseline_count::VARCHAR, 'None') || ' deviation=' || coalesce(deviation_pct::VARCHAR, 'None') || '%.' AS t_count,
    'Null-rate check on drug_name: ' || nn || '/' || total || ' rows (' || pct || '%) are NULL.' AS t_null,
    CASE WHEN fresh IS NULL THEN 'No freshness check recorded yet.' ELSE 'Latest freshness check: last_loaded='
        || coalesce(rtrim(rtrim(strftime(last_loaded, '%Y-%m-%d %H:%M:%S.%f'), '0'), '.'), 'None') || ' is_stale=' || is_stale || '.' END AS t_fresh
  FROM j),
ev AS (SELECT * EXCLUDE (a, r, t), t_memory || ' ' || CASE error_type WHEN 'schema_drift' THEN t_drift WHEN 'volume_anomaly' THEN t_count
           WHEN 'data_quality' THEN t_null WHEN 'data_corruption' THEN t_null || ' ' || t_count WHEN 'freshness' THEN t_fresh
           ELSE 'Nothing but past incidents was looked at: no check is made for failures of this kind.' END AS evidence,
         CASE error_type WHEN 'schema_drift' THEN 'schema_diff,lineage' WHEN 'volume_anomaly' THEN 'row_count'
           WHEN 'data_quality' THEN 'null_rate' WHEN 'data_corruption' THEN 'null_rate,row_count'
           WHEN 'freshness' THEN 'freshness' ELSE 'past_incidents' END AS tool_used
       FROM texts)
"""


@query("evidence", EVIDENCE + """
SELECT incident_id, tool_used, changed_column, evidence,
       CASE WHEN error_type = 'schema_drift' THEN to_json(model_names)::VARCHAR END AS detail_models,
       CASE WHEN error_type = 'schema_drift' THEN to_json(referencing_names)::VARCHAR END AS detail_referencing,
       CASE WHEN error_type IN ('volume_anomaly', 'data_corruption') THEN current_count::VARCHAR END AS detail_count,
       CASE WHEN error_type IN ('data_quality', 'data_corruption') THEN nn::VARCHAR END AS detail_nulls,
       n_similar::VARCHAR AS detail_similar
FROM ev
""")
def evidence(spark, sf):
    """The summary of each incident, and from its details what each check found."""
    found = triage.investigate(_classified(spark, sf), **_evidence_inputs(spark, sf))
    detail = lambda path, name: F.get_json_object("details", path).alias(f"detail_{name}")
    return found.select(
        "incident_id", "tool_used", "changed_column", "evidence", detail("$.impact.models", "models"),
        detail("$.impact.referencing", "referencing"), detail("$.count.current_count", "count"),
        detail("$.null.null_rows", "nulls"), detail("$.similar.n_similar", "similar"))


def _proposals(spark, sf):
    """Proposed fixes as a person or a model would supply them, for the alerts nobody labelled."""
    event = F.col("incident_id")
    return b.alerts(spark, sf).where(F.col("label").isNull()).select(
        "incident_id", F.concat(F.lit("Proposal for "), event.cast("string")).alias("description"),
        b.pick(["low", "medium", "high"], event % 3).alias("risk_level"), b._statement("incident_id").alias("sql"),
    )


def _fixed(spark, sf, found):
    memory = b.incident_vectors(spark, sf)
    renames = incidents_renames(spark, sf)
    reusable = triage.reusable_by_incident(memory, memory, REUSE_SCORE)
    return incidents.choose_fix(found, renames, reusable, _proposals(spark, sf))


def incidents_renames(spark, sf):
    return rename_candidates(b.live_columns(spark, sf), b.declared_columns(spark, sf))


FIXES = REUSABLE + f"""
, reuse AS (SELECT query_id AS incident_id, score, description, risk_level, sql FROM r JOIN x_vectors v ON v.incident_id = match_id),
proposal AS (SELECT incident_id, 'Proposal for ' || incident_id AS description,
                    (['low', 'medium', 'high'])[incident_id % 3 + 1] AS risk_level, s.sql
             FROM x_alerts JOIN x_statements s ON n = incident_id % {len(STATEMENTS)} WHERE label IS NULL),
fixes AS (
    SELECT c.*, current_name IS NOT NULL AS rename_valid,
           printf('ALTER TABLE %s.%s RENAME COLUMN "%s" TO "%s"', schema_name, table_name, current_name, canonical_name) AS rename_sql, CASE
        WHEN severity = 'P3' THEN ['none', 'P3 (upstream/infra) — no fix attempted, logged only.', 'low', NULL]
        WHEN error_type = 'schema_drift' AND current_name IS NOT NULL THEN
            ['mechanical', 'Rename column ''' || current_name || ''' back to ''' || canonical_name || '''.', 'low',
             'ALTER TABLE ' || schema_name || '.' || table_name || ' RENAME COLUMN "' || current_name || '" TO "' || canonical_name || '"']
        WHEN u.score IS NOT NULL THEN
            ['reuse', printf('Reusing a previously successful fix for a similar incident (similarity %.2f): %s', round(u.score, 2),
                             u.description), coalesce(u.risk_level, 'medium'), u.sql]
        WHEN p.description IS NOT NULL THEN ['proposal', p.description, p.risk_level, p.sql]
        ELSE ['needs_proposal', NULL, 'high', NULL] END AS fix
    FROM x_classified c LEFT JOIN x_renames USING (schema_name, table_name)
    LEFT JOIN reuse u USING (incident_id) LEFT JOIN proposal p USING (incident_id))
"""


@query("choose_fix", FIXES + """
SELECT incident_id, severity, error_type, fix[1] AS source, fix[2] AS description, fix[3] AS risk_level, fix[4] AS sql,
       rename_valid::VARCHAR AS rename_valid FROM fixes
""")
def choose_fix(spark, sf):
    return _fixed(spark, sf, _classified(spark, sf)).select("incident_id", "severity", "error_type", "fix.*", "rename_valid")


# Statements written by rename repairs name a monitored table each, which the allow list has to contain.
ALLOWED_TRACKED = [f"raw.{kind}_{number}" for kind in b.EVENT_TYPES for number in range(4)]


def _allowed():
    return ALLOWED_TABLES + ALLOWED_TRACKED


ROUTED = FIXES + """
, tiered AS (
    SELECT f.*, CASE WHEN fix[1] = 'mechanical' THEN 'auto_executable' ELSE a.tier END AS tier,
           CASE WHEN fix[1] = 'mechanical' THEN 'column rename' ELSE a.reason END AS reason,
           '[' || severity || '/' || coalesce(error_type, 'upstream_failure') || '] ' || dag_id || '.' || task_id || ' (run '
               || run_id || '): ' || coalesce(fix[2], '') AS line
    FROM fixes f LEFT JOIN x_audited a ON a.sql = f.fix[4]),
routed AS (
    SELECT *, CASE WHEN severity = 'P0' THEN 'escalated' WHEN severity = 'P3' OR tier IS NULL THEN 'auto_approved'
                   WHEN tier = 'rejected' THEN 'escalated' WHEN tier = 'needs_approval' THEN 'pending' ELSE 'auto_approved' END AS approval_status,
           severity IN ('P1', 'P2') AND coalesce(tier = 'auto_executable', FALSE) AND rename_valid AS fix_executed,
           CASE WHEN severity = 'P0' THEN 'pause,notify,request_approval' WHEN severity = 'P3' THEN 'log'
                WHEN tier IS NULL THEN 'retry' || CASE severity WHEN 'P1' THEN ',notify' ELSE '' END
                WHEN tier = 'rejected' THEN 'notify' WHEN tier = 'needs_approval' THEN 'request_approval'
                WHEN NOT rename_valid THEN 'retry'
                ELSE 'apply_rename,retry' || CASE severity WHEN 'P1' THEN ',notify' ELSE '' END END AS actions,
           CASE WHEN severity = 'P0' THEN 0 WHEN severity = 'P3' THEN NULL WHEN tier = 'needs_approval'
                THEN CASE severity WHEN 'P1' THEN 30 ELSE 0 END END AS timeout_minutes
    FROM tiered)
"""


@query("route_decisions", ROUTED + """
SELECT incident_id, severity, tier, reason AS tier_reason, approval_status, fix_executed::VARCHAR AS fix_executed,
       timeout_minutes::BIGINT AS timeout_minutes, actions, line FROM routed
""")
def route_decisions(spark, sf):
    routed = incidents.route(_fixed(spark, sf, _classified(spark, sf)), _allowed())
    return routed.select("incident_id", "severity", "tier", "tier_reason", "approval_status", "fix_executed",
                         "timeout_minutes", "actions", "line")


@query("route_actions", ROUTED + """
, steps AS (SELECT *, unnest(string_split(actions, ',')) AS action, generate_subscripts(string_split(actions, ','), 1) - 1 AS step FROM routed)
SELECT incident_id, step, action, approval_status AS status,
       CASE WHEN action = 'apply_rename' THEN rename_sql
            WHEN action = 'request_approval' AND reason IS NOT NULL THEN line || chr(10) || '(' || reason || ')'
            WHEN action = 'notify' AND tier = 'rejected' THEN line || chr(10) || 'Reason: ' || reason || chr(10) || 'Proposed SQL: ' || fix[4]
            ELSE line END AS detail
FROM steps
""")
def route_actions(spark, sf):
    return incidents.actions(incidents.route(_fixed(spark, sf, _classified(spark, sf)), _allowed()))


@query("approval_requests", ROUTED + """
SELECT incident_id, dag_id, run_id, task_id, CASE severity WHEN 'P0' THEN line ELSE line || chr(10) || '(' || reason || ')' END AS summary,
       fix[3] AS risk_level, severity, CASE WHEN severity <> 'P0' THEN fix[4] END AS proposed_sql,
       timeout_minutes::BIGINT AS timeout_minutes,
       CASE WHEN severity = 'P0' THEN 'P0 — DAG PAUSED — urgent response required'
            WHEN severity = 'P1' THEN 'P1 — will auto-apply in 30 min if unanswered'
            WHEN fix[3] = 'high' THEN 'HIGH RISK — do not auto-apply' ELSE 'Review needed' END AS urgency
FROM routed WHERE contains(actions, 'request_approval')
""")
def approval_requests(spark, sf):
    asked = incidents.approval_requests(incidents.route(_fixed(spark, sf, _classified(spark, sf)), _allowed()))
    return asked.withColumn("urgency", approvals.urgency(F.col("severity"), F.col("timeout_minutes"), F.col("risk_level")))


RECORDS = ROUTED + EVIDENCE + """
, records AS (
    SELECT routed.incident_id, created_at, dag_id, run_id, task_id, error_type, severity, error_message,
           coalesce(error_type, 'unknown_error') || ' on ' || dag_id || '.' || task_id || ' (run ' || run_id || ')' AS summary,
           evidence AS root_cause, coalesce(fix[2], 'No fix proposed.') AS resolution, fix[3] AS risk_level,
           approval_status, fix[4] AS sql, tier AS sql_tier, fix_executed AND fix[4] IS NOT NULL AS has_sql_fix
    FROM routed JOIN (SELECT incident_id, evidence FROM ev) USING (incident_id))
"""


def _records(spark, sf):
    found = triage.investigate(_classified(spark, sf), **_evidence_inputs(spark, sf))
    routed = incidents.route(_fixed(spark, sf, found), _allowed())
    return incidents.incident_records(routed, F.col("created_at"), _allowed())


@query("incident_records", RECORDS + f"""
SELECT * REPLACE ({stamp('created_at')} AS created_at, has_sql_fix::VARCHAR AS has_sql_fix),
       summary || chr(10) || root_cause || chr(10) || resolution AS embedding_text FROM records
""")
def incident_records(spark, sf):
    return _records(spark, sf)


@query("incident_reports_rows", RECORDS + f"""
SELECT dag_id, run_id, task_id, error_type, coalesce(nullif(error_message, ''), root_cause) AS error_message, resolution AS fix_attempted,
       approval_status AS fix_result, CASE WHEN approval_status = 'auto_approved' THEN 'true' END AS approved, sql AS fix_sql,
       {stamp('created_at')} AS created_at FROM records
""")
def incident_reports_rows(spark, sf):
    return incidents.incident_reports(_records(spark, sf))


@query("stream_records", ROUTED + f"""
, plain AS (
    SELECT routed.*, coalesce(error_type, 'unknown_error') || ' on ' || dag_id || '.' || task_id || ' (run ' || run_id || ')' AS summary
    FROM routed)
SELECT 'memory' AS sink, incident_id, summary, coalesce(fix[2], 'No fix proposed.') AS resolution, tier AS sql_tier,
       (fix_executed AND fix[4] IS NOT NULL)::VARCHAR AS flag FROM plain
UNION ALL
SELECT 'reports', NULL, error_message, coalesce(fix[2], 'No fix proposed.'), fix[4],
       CASE WHEN approval_status = 'auto_approved' THEN 'true' END FROM plain
""")
def stream_records(spark, sf):
    """Routed incidents arrive as a stream and are kept in the incident memory and in the reporting table."""
    root = shared_dir(spark, "records")
    warehouse = Warehouse(root)
    routed = incidents.route(_fixed(spark, sf, _classified(spark, sf)), _allowed()).withColumn("evidence", F.lit(""))
    routed.withColumn("fix", F.struct("fix.*")).write.parquet(f"{root}/routed")
    schema = spark.read.parquet(f"{root}/routed").schema
    stream = spark.readStream.schema(schema).parquet(f"{root}/routed")
    records.start_records(stream, "created_at", warehouse, _allowed(), f"{root}/checkpoint").awaitTermination()
    memory = records.memory_table(warehouse).read(spark).select(
        F.lit("memory").alias("sink"), "incident_id", "summary", "resolution", "sql_tier",
        F.col("has_sql_fix").cast("string").alias("flag"))
    written = spark.read.parquet(warehouse.path("monitoring", "incident_reports"))
    return memory.unionByName(written.select(
        F.lit("reports").alias("sink"), F.lit(None).cast("bigint").alias("incident_id"), F.col("error_message").alias("summary"),
        F.col("fix_attempted").alias("resolution"), F.col("fix_sql").alias("sql_tier"), F.col("approved").cast("string").alias("flag")))


# --- approvals -------------------------------------------------------------------------------------------------------

@query("approval_upsert", f"""
, new AS (SELECT * FROM x_requests QUALIFY row_number() OVER (PARTITION BY incident_id ORDER BY requested_at DESC) = 1),
merged AS (
    SELECT coalesce(o.incident_id, n.incident_id) AS incident_id, coalesce(o.dag_id, n.dag_id) AS dag_id,
           coalesce(o.run_id, n.run_id) AS run_id, coalesce(o.task_id, n.task_id) AS task_id,
           CASE WHEN n.incident_id IS NULL THEN o.summary ELSE n.summary END AS summary,
           CASE WHEN n.incident_id IS NULL THEN o.risk_level ELSE n.risk_level END AS risk_level,
           CASE WHEN n.incident_id IS NULL THEN o.severity ELSE n.severity END AS severity,
           CASE WHEN n.incident_id IS NULL THEN o.proposed_sql ELSE n.proposed_sql END AS proposed_sql,
           coalesce(o.status, 'pending') AS status, coalesce(o.created_at, TIMESTAMP {q(AS_OF)}) AS created_at, o.resolved_at,
           o.resolved_by, o.escalation_email_sent_at, o.dag_paused_at
    FROM x_approvals o FULL JOIN new n ON o.incident_id = n.incident_id)
SELECT {APPROVAL_OUT} FROM merged
""")
def approval_upsert(spark, sf):
    return approvals.request(b.approvals(spark, sf), b.requests(spark, sf), [F.desc("requested_at")], AS_OF)


DECIDED = f"""
, decided AS (
    SELECT a.* REPLACE (CASE d.action WHEN 'approve' THEN 'approved' WHEN 'reject' THEN 'rejected' ELSE a.status END AS status,
                        CASE WHEN d.action IS NULL THEN a.resolved_at ELSE TIMESTAMP {q(AS_OF)} END AS resolved_at,
                        CASE WHEN d.action IS NULL THEN a.resolved_by ELSE coalesce(d.username, 'unknown') END AS resolved_by)
    FROM x_approvals a LEFT JOIN x_last_decisions d USING (incident_id))
"""


@query("approval_decisions", DECIDED + f"SELECT {APPROVAL_OUT} FROM decided")
def approval_decisions(spark, sf):
    return approvals.decide(b.approvals(spark, sf), b.decisions(spark, sf), [F.desc("decided_at")], AS_OF)


@query("approved_fix_steps", f"""
SELECT incident_id, severity, proposed_sql,
       CASE WHEN severity NOT IN ('P1', 'P2') THEN 'acknowledge' WHEN coalesce(proposed_sql, '') = '' THEN 'retry'
            WHEN tier = 'rejected' THEN 'refuse' WHEN tier = 'auto_executable' THEN 'apply_rename_and_retry'
            ELSE 'run_statement_and_retry' END AS step
FROM x_approvals LEFT JOIN x_audited ON sql = proposed_sql WHERE status = 'approved'
""")
def approved_fix_steps(spark, sf):
    done = b.approvals(spark, sf).where(F.col("status") == "approved").select("incident_id", "severity", "proposed_sql")
    return approvals.fix_steps(done)


@query("approval_status", f"""
SELECT r.incident_id, coalesce(status, 'unknown') AS status, {stamp('resolved_at')} AS resolved_at, resolved_by
FROM (SELECT DISTINCT incident_id FROM x_requests) r LEFT JOIN x_approvals USING (incident_id)
""")
def approval_status(spark, sf):
    return approvals.status_of(b.requests(spark, sf).select("incident_id").distinct(), b.approvals(spark, sf))


LATER = "2024-03-01 00:10:00"
TIMEOUT_STEP = """CASE WHEN coalesce(proposed_sql, '') = '' THEN 'retry' WHEN tier = 'rejected' THEN 'refuse'
    WHEN tier = 'auto_executable' THEN 'apply_rename_and_retry' ELSE 'run_statement_and_retry' END"""
DUE = f"""
, due AS (SELECT *, epoch(TIMESTAMP '{LATER}' - created_at) / 60 AS age_minutes FROM x_approvals),
acts AS (
    SELECT incident_id, severity, age_minutes, 'auto_apply' AS action FROM due WHERE status = 'pending' AND severity = 'P1' AND age_minutes >= 30
    UNION ALL SELECT incident_id, severity, age_minutes, 'send_mail' FROM due
    WHERE status = 'pending' AND severity = 'P0' AND escalation_email_sent_at IS NULL AND age_minutes >= 30
    UNION ALL SELECT incident_id, severity, age_minutes, 'pause_dag' FROM due
    WHERE status = 'pending' AND severity = 'P0' AND dag_paused_at IS NULL AND age_minutes >= 60)
"""


@query("escalation_ladder", DUE + f"""
SELECT acts.*, CASE WHEN action = 'auto_apply' THEN {TIMEOUT_STEP} END AS step
FROM acts JOIN x_approvals USING (incident_id) LEFT JOIN x_audited ON sql = proposed_sql
""".replace("acts.*", "acts.incident_id, acts.severity, age_minutes, action"))
def escalation_ladder(spark, sf):
    return approvals.ladder(b.approvals(spark, sf), LATER)


@query("escalation_applied", DUE + f"""
, after AS (
    SELECT a.* REPLACE (CASE WHEN p.action IS NULL THEN a.status
                             WHEN coalesce(a.proposed_sql, '') <> '' AND t.tier = 'rejected' THEN 'refused'
                             ELSE 'auto_approved' END AS status,
               CASE WHEN p.action IS NULL THEN a.resolved_at ELSE TIMESTAMP '{LATER}' END AS resolved_at,
               CASE WHEN p.action IS NULL THEN a.resolved_by ELSE 'escalation_timeout' END AS resolved_by,
               CASE WHEN m.action IS NULL THEN a.escalation_email_sent_at ELSE TIMESTAMP '{LATER}' END AS escalation_email_sent_at,
               CASE WHEN d.action IS NULL THEN a.dag_paused_at ELSE TIMESTAMP '{LATER}' END AS dag_paused_at)
    FROM x_approvals a LEFT JOIN (SELECT * FROM acts WHERE action = 'auto_apply') p USING (incident_id)
    LEFT JOIN (SELECT * FROM acts WHERE action = 'send_mail') m USING (incident_id)
    LEFT JOIN (SELECT * FROM acts WHERE action = 'pause_dag') d USING (incident_id)
    LEFT JOIN x_audited t ON t.sql = a.proposed_sql)
SELECT {APPROVAL_OUT} FROM after
""")
def escalation_applied(spark, sf):
    return approvals.climb(b.approvals(spark, sf), LATER)
