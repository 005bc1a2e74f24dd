"""The inputs of ``inputs.py`` once more as SQL, written independently of the DataFrame versions."""

from __future__ import annotations

from caselight.bindings.texts import AS_OF, DAG_ID, ERROR_TYPE_CYCLE, LOGS, STATEMENTS
from caselight.functions.logs import HINT_PATTERNS
from caselight.functions.statements import ALLOWED_TABLES
from caselight.plans.reports import TASKS


def q(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def array(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def day(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d')"


def stamp(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"


RUN = (
    f"{q(DAG_ID)} AS dag_id, 'run-' || (event_id // 5) AS run_id, "
    f"({array(TASKS)})[event_id % 5 + 1] AS task_id"
)
LOG = f"({array(LOGS)})[user_id % {len(LOGS)} + 1]"
TYPES = f"({array(ERROR_TYPE_CYCLE)})[user_id % 6 + 1]"
TIME = f"TIMESTAMP {q(AS_OF)}"


def statement(key: str) -> str:
    return f"({array(STATEMENTS)})[{key} % {len(STATEMENTS)} + 1]"


def severity(error_type: str) -> str:
    return (
        f"CASE WHEN {error_type} = 'data_corruption' THEN 'P0' WHEN {error_type} IN ('schema_drift', 'volume_anomaly') "
        f"THEN 'P1' WHEN {error_type} IN ('data_quality', 'freshness') THEN 'P2' ELSE 'P3' END"
    )


def hint(message: str) -> str:
    cases = " ".join(f"WHEN regexp_matches({message}, {q(pattern)}, 'i') THEN {q(name)}" for name, pattern in HINT_PATTERNS)
    return f"CASE {cases} END"


CTES: dict[str, str] = {}

# --- reports ---------------------------------------------------------------------------------------------------------

CTES["x_raw"] = """
SELECT l_orderkey || '-' || l_linenumber AS report_id,
       strftime(l_shipdate, '%Y%m%d') AS received_date,
       CASE l_returnflag WHEN 'R' THEN '1' WHEN 'A' THEN '2' END AS serious,
       CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' AND l_quantity > 40 THEN '1' END AS serious_death,
       CASE WHEN l_discount >= 0.08 THEN '1' WHEN l_discount <= 0.01 THEN '' ELSE '2' END AS serious_hosp,
       CASE WHEN l_tax >= 0.06 THEN ' 1 ' END AS serious_life,
       l_quantity::DECIMAL(10, 2) AS patient_age,
       '801' AS patient_age_unit,
       CASE WHEN c_custkey % 2 = 0 THEN '1' ELSE '2' END AS patient_sex,
       CASE WHEN l_partkey % 50 <> 0 THEN ' ' || p_name || ' ' || lower(p_type) END AS drug_name,
       p_type AS drug_indication,
       upper(p_brand) AS reaction,
       (l_linenumber % 3 + 1)::VARCHAR AS outcome,
       n_name AS country,
       l_shipdate AS loaded_at,
       l_shipdate::DATE AS load_date,
       l_partkey AS source_row
FROM lineitem
JOIN part ON p_partkey = l_partkey
JOIN orders ON o_orderkey = l_orderkey
JOIN customer ON c_custkey = o_custkey
JOIN nation ON n_nationkey = c_nationkey
"""
CTES["x_loaded"] = """
SELECT * FROM x_raw QUALIFY row_number() OVER (PARTITION BY report_id ORDER BY loaded_at DESC, source_row DESC) = 1
"""


def staged(source: str) -> str:
    flag = lambda c: f"nullif(trim({c}), '') = '1' AS {c}"
    return f"""
    SELECT trim(report_id) AS report_id,
           strptime(nullif(trim(received_date), ''), '%Y%m%d')::DATE AS received_date,
           {flag('serious')}, {flag('serious_death')}, {flag('serious_hosp')}, {flag('serious_life')},
           patient_age::DOUBLE AS patient_age, trim(patient_age_unit) AS patient_age_unit,
           trim(patient_sex) AS patient_sex, upper(trim(drug_name)) AS drug_name,
           trim(drug_indication) AS drug_indication, lower(trim(reaction)) AS reaction, trim(outcome) AS outcome,
           trim(country) AS country, coalesce(trim(serious) = '1', FALSE) AS is_serious,
           coalesce(trim(serious_death) = '1', FALSE) AS is_fatal, loaded_at, load_date
    FROM {source} WHERE trim(coalesce(report_id, '')) <> ''
    """


CTES["x_staged"] = staged("x_loaded")
CTES["x_reactions"] = """
SELECT drug_name, reaction, count(*) AS report_count, sum(is_serious::INT)::BIGINT AS serious_count,
       sum(is_fatal::INT)::BIGINT AS fatal_count, round(avg(patient_age), 1) AS avg_patient_age,
       max(received_date) AS most_recent_report_date
FROM x_staged GROUP BY ALL
"""

# --- runs and incidents ----------------------------------------------------------------------------------------------

CTES["x_runs"] = f"""
SELECT {RUN},
       CASE WHEN event_type = 'error' THEN 'failed' WHEN event_id % 50 = 7 THEN 'running' ELSE 'success' END AS status,
       event_id % 1000 AS rows_processed,
       CASE WHEN event_type = 'error' AND event_id % 27 <> 0 THEN {LOG} END AS error_message,
       ts AS started_at,
       CASE WHEN event_type = 'error' OR event_id % 50 <> 7 THEN ts + to_seconds(floor(value)::BIGINT) END AS finished_at
FROM events
"""
CTES["x_incidents"] = f"""
SELECT event_id, {RUN}, {TYPES} AS error_type, {LOG} AS error_message,
       nullif((['', 'Retried the task.', 'Renamed a column back to its declared name and retried the failed task.',
                'No SQL fix makes sense here; a person has to look at the data'])[event_id % 4 + 1], '') AS fix_attempted,
       (['auto_approved', 'auto_approved', 'approved', 'rejected', 'escalated', 'pending', 'pending'])[event_id % 7 + 1]
           AS fix_result,
       CASE WHEN event_id % 7 <= 2 THEN TRUE WHEN event_id % 7 = 3 THEN FALSE END AS approved,
       CASE WHEN event_id % 3 <> 0 THEN {statement('event_id')} END AS fix_sql,
       ts AS created_at
FROM events WHERE event_type = 'error'
"""
CTES["x_alerts"] = f"""
SELECT event_id AS incident_id, {RUN},
       CASE event_id % 9 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE {LOG} END AS log_text,
       CASE WHEN event_id % 4 = 0 THEN {TYPES} END AS label,
       'raw' AS schema_name,
       (['click', 'error', 'purchase', 'signup', 'view'])[user_id % 5 + 1] || '_' || event_id % 4 AS table_name,
       ts AS created_at
FROM events WHERE event_type = 'error'
"""
CTES["x_failed"] = """
SELECT dag_id, run_id, task_id, error_message AS message FROM x_runs WHERE status = 'failed'
QUALIFY row_number() OVER (PARTITION BY dag_id, run_id, task_id ORDER BY finished_at DESC NULLS FIRST) = 1
"""
CTES["x_backfilled"] = """
SELECT a.*, CASE WHEN a.log_text <> '' THEN a.log_text WHEN f.message IS NOT NULL THEN f.message
            ELSE 'No error_message found in monitoring.pipeline_runs for dag_id=' || a.dag_id || ' run_id=' || a.run_id
                 || ' task_id=' || a.task_id END AS raw_log
FROM x_alerts a LEFT JOIN x_failed f USING (dag_id, run_id, task_id)
"""
CTES["x_parsed"] = f"""
SELECT *, {hint('error_message')} AS error_type_hint FROM (
    SELECT *, regexp_replace(
        CASE WHEN contains(raw_log, 'Traceback (most recent call last):')
             THEN list_filter(string_split(raw_log, chr(10)), lambda line: trim(line) <> '')[-1] ELSE raw_log END,
        '^\\s+|\\s+$', '', 'g') AS error_message
    FROM x_backfilled)
"""
CTES["x_classified"] = f"""
SELECT *, {severity('error_type')} AS severity
FROM (SELECT *, coalesce(label, error_type_hint) AS error_type FROM x_parsed)
"""

# --- monitored tables ------------------------------------------------------------------------------------------------

CTES["x_tracked"] = """
SELECT *, 'raw' AS schema_name, event_type || '_' || event_id % 4 AS table_name FROM events
"""
CTES["x_stats"] = """
SELECT schema_name, table_name, count(*) AS current_count, max(ts) AS last_loaded FROM x_tracked GROUP BY ALL
"""
CTES["x_baselines"] = """
SELECT schema_name, table_name, count(*) FILTER (
    table_name <> 'purchase_0' AND ts < CASE event_type WHEN 'click' THEN TIMESTAMP '2024-01-29'
        WHEN 'error' THEN TIMESTAMP '2024-01-22' ELSE TIMESTAMP '2024-01-16' END) AS baseline_count
FROM x_tracked WHERE table_name <> 'error_3' GROUP BY ALL
"""
CTES["x_counts"] = """
SELECT *, round(deviation * 100, 2) AS deviation_pct,
       CASE WHEN deviation > 0.5 THEN 'critical' WHEN deviation > 0.3 THEN 'warning' END AS severity
FROM (SELECT schema_name, table_name, current_count, baseline_count,
             CASE WHEN baseline_count = 0 THEN (current_count > 0)::INT::DOUBLE
                  ELSE abs(current_count - baseline_count) / baseline_count END AS deviation
      FROM x_stats LEFT JOIN x_baselines USING (schema_name, table_name))
"""
CTES["x_freshness"] = """
SELECT schema_name, table_name, ts - to_minutes(floor(value)::BIGINT) AS last_loaded, ts AS checked_at,
       value > 100 AS is_stale,
       CASE WHEN user_id % 3 <> 0 THEN CASE WHEN event_id % 11 = 0 THEN 'cached' ELSE 'live' END END AS data_source
FROM x_tracked
"""
CTES["x_freshness_status"] = """
SELECT table_name, schema_name, last_loaded, is_stale, coalesce(data_source, 'live') AS data_source
FROM x_freshness QUALIFY row_number() OVER (PARTITION BY schema_name, table_name ORDER BY checked_at DESC) = 1
"""
CTES["x_declared"] = """
SELECT DISTINCT schema_name, table_name, 'c' || n AS column_name, (['text', 'bigint', 'numeric'])[n % 3 + 1] AS data_type,
       CASE WHEN n % 4 = 0 THEN 'NO' ELSE 'YES' END AS is_nullable
FROM (SELECT *, event_id // 4 % 12 AS n FROM x_tracked)
"""
CTES["x_live"] = """
SELECT schema_name, table_name,
       CASE WHEN table_name LIKE '%1' AND column_name = 'c3' THEN 'c3_new' ELSE column_name END AS column_name,
       CASE WHEN table_name LIKE '%2' AND column_name = 'c5' THEN 'date' ELSE data_type END AS data_type,
       CASE WHEN table_name LIKE '%2' AND column_name = 'c8' THEN 'YES' ELSE is_nullable END AS is_nullable
FROM x_declared WHERE NOT (table_name LIKE '%3' AND column_name = 'c4')
UNION ALL
SELECT schema_name, table_name, column_name || '_extra', data_type, is_nullable
FROM x_declared WHERE table_name LIKE '%3' AND column_name IN ('c6', 'c7')
"""
CTES["x_diff"] = """
SELECT schema_name, table_name, table_name NOT LIKE 'view%' AS has_prior_snapshot,
       CASE WHEN has_prior_snapshot THEN list(column_name ORDER BY column_name) FILTER (o.column_name IS NULL) END AS added,
       list(column_name ORDER BY column_name) FILTER (l.column_name IS NULL) AS removed,
       list(column_name ORDER BY column_name) FILTER (l.data_type <> o.data_type OR l.is_nullable <> o.is_nullable)
           AS changed_types
FROM (SELECT *, TRUE AS here FROM x_live) l
FULL JOIN (SELECT * FROM x_declared WHERE table_name NOT LIKE 'view%') o USING (schema_name, table_name, column_name)
GROUP BY schema_name, table_name
"""
CTES["x_renames"] = """
SELECT schema_name, table_name, extra_count, missing_count,
       CASE WHEN extra_count = 1 AND missing_count = 1 THEN extra END AS current_name,
       CASE WHEN extra_count = 1 AND missing_count = 1 THEN missing END AS canonical_name
FROM (SELECT schema_name, table_name, count(*) FILTER (d.data_type IS NULL) AS extra_count,
             count(*) FILTER (l.data_type IS NULL) AS missing_count,
             max(column_name) FILTER (d.data_type IS NULL) AS extra,
             max(column_name) FILTER (l.data_type IS NULL) AS missing
      FROM x_live l FULL JOIN x_declared d USING (schema_name, table_name, column_name) GROUP BY ALL)
"""

# --- approvals -------------------------------------------------------------------------------------------------------

CTES["x_approvals"] = f"""
SELECT o_orderkey::VARCHAR AS incident_id, {q(DAG_ID)} AS dag_id, 'run-' || o_custkey AS run_id,
       ({array(TASKS)})[o_orderkey % 5 + 1] AS task_id, 'order ' || o_orderkey AS summary,
       (['low', 'medium', 'high'])[o_orderkey % 3 + 1] AS risk_level, 'P' || o_custkey % 4 AS severity,
       CASE WHEN o_orderkey % 17 <> 0 THEN {statement('o_orderkey')} END AS proposed_sql,
       CASE o_orderstatus WHEN 'F' THEN 'approved' ELSE 'pending' END AS status,
       {TIME} - to_minutes(o_orderkey % 90) AS created_at,
       CASE o_orderstatus WHEN 'F' THEN {TIME} END AS resolved_at,
       CASE o_orderstatus WHEN 'F' THEN 'ana' END AS resolved_by,
       CASE WHEN o_orderkey % 5 = 0 THEN {TIME} END AS escalation_email_sent_at,
       CASE WHEN o_orderkey % 7 = 0 THEN {TIME} END AS dag_paused_at
FROM orders
"""
CTES["x_requests"] = f"""
SELECT CASE WHEN event_id // 4 % 3 = 0 THEN 'n' ELSE '' END || (event_id // 4) AS incident_id, {RUN},
       'event ' || event_id AS summary, (['low', 'medium', 'high'])[user_id % 3 + 1] AS risk_level,
       'P' || user_id % 3 AS severity, {statement('user_id')} AS proposed_sql, ts AS requested_at
FROM events WHERE event_type = 'error'
"""
CTES["x_decisions"] = """
SELECT (event_id // 3 * 5)::VARCHAR AS incident_id,
       CASE WHEN user_id % 2 = 0 THEN 'approve' ELSE 'reject' END AS action,
       CASE WHEN user_id % 10 <> 0 THEN 'user' || user_id END AS username, ts AS decided_at
FROM events WHERE event_type = 'purchase'
"""
CTES["x_last_decisions"] = """
SELECT * FROM x_decisions QUALIFY row_number() OVER (PARTITION BY incident_id ORDER BY decided_at DESC) = 1
"""

# --- statements ------------------------------------------------------------------------------------------------------

CTES["x_statements"] = f"""
SELECT i - 1 AS n, ({array(STATEMENTS)})[i] AS sql FROM range(1, {len(STATEMENTS) + 1}) r(i)
"""
# No look-around and no back references here: the tags that the samples use are spelled out.
_QUOTED = ("\\b[eE]''(?:[^''\\\\]|\\\\[\\s\\S]|'''')*''|''(?:[^'']|'''')*''|\"(?:[^\"]|\"\")*\""
           "|\\$\\$[\\s\\S]*?\\$\\$|\\$q\\$[\\s\\S]*?\\$q\\$")
_COMMENT = "--[^\\r\\n]*|/\\*(?:[^*/]|\\*+[^*/]|/+[^*/])*\\*+/"
_REF = (
    r'\b(?:FROM|UPDATE|INTO|TABLE|TRUNCATE)\s+"?([a-zA-Z_][a-zA-Z0-9_]*)"?\s*\.\s*"?([a-zA-Z_][a-zA-Z0-9_]*)"?'
)
_WORDS = "SELECT|INSERT|UPDATE|DELETE|MERGE|CREATE|ALTER|DROP|UPSERT|REPLACE"
CTES["x_parts"] = f"""
SELECT *, list_filter(string_split(regexp_replace(sql, '{_QUOTED}|{_COMMENT}', 'q', 'g'), ';'),
                      lambda p: regexp_matches(p, '\\S')).len() AS parts,
       regexp_replace(regexp_replace(sql, '({_QUOTED})|{_COMMENT}', '\\1 ', 'g'), '{_QUOTED}', 'q', 'g') AS bare,
       list_sort(list_distinct(list_transform(
           list_zip(regexp_extract_all(sql, '{_REF}', 1, 'i'), regexp_extract_all(sql, '{_REF}', 2, 'i')),
           lambda r: lower(r[1] || '.' || r[2])))) AS tables
FROM x_statements
"""
CTES["x_chars"] = """
SELECT n, i, c, sum(CASE c WHEN '(' THEN 1 WHEN ')' THEN -1 ELSE 0 END) OVER (PARTITION BY n ORDER BY i) AS depth
FROM (SELECT n, unnest(string_split(bare, '')) AS c, generate_subscripts(string_split(bare, ''), 1) AS i FROM x_parts)
"""
CTES["x_outside"] = """
SELECT n, string_agg(CASE WHEN depth = 0 AND c <> ')' THEN c ELSE ' ' END, '' ORDER BY i) AS top,
       min(depth) = 0 AND arg_max(depth, i) = 0 AS balanced
FROM x_chars GROUP BY n
"""
CTES["x_typed"] = f"""
SELECT *, CASE WHEN regexp_matches(word, '^({_WORDS})$') THEN word ELSE 'UNKNOWN' END AS kind,
       coalesce(balanced, true) AND NOT regexp_matches(bare, '[''"]|/\\*|\\*/|\\$q?\\$') AS closed,
       list_filter(tables, lambda t: NOT list_contains({array(ALLOWED_TABLES)}, t)) AS outside
FROM (SELECT *, CASE WHEN upper(regexp_extract(bare, '^\\s*([A-Za-z]+)', 1)) = 'WITH'
                     THEN upper(regexp_extract(top, '\\b({_WORDS})\\b', 1, 'i'))
                     ELSE upper(regexp_extract(bare, '^\\s*([A-Za-z]+)', 1)) END AS word
      FROM (SELECT x_parts.*, top, balanced FROM x_parts LEFT JOIN x_outside USING (n)))
"""
CTES["x_audited"] = r"""
SELECT n, sql, split_part(verdict, '|', 1) AS tier, split_part(verdict, '|', 2) AS reason,
       CASE WHEN trim(sql) <> '' AND parts = 1 THEN kind END AS statement_type, tables
FROM (SELECT *, CASE
        WHEN trim(sql) = '' THEN 'rejected|no statement'
        WHEN NOT closed THEN 'rejected|quotes, comments or parentheses that do not close'
        WHEN parts <> 1 THEN 'rejected|expected one statement, found ' || parts
        WHEN len(tables) = 0 THEN 'rejected|no table could be identified'
        WHEN len(outside) > 0 THEN 'rejected|tables outside the allow list: ' || array_to_string(outside, ', ')
        WHEN contains(upper(sql), 'DROP') OR contains(upper(sql), 'TRUNCATE') THEN 'rejected|drop or truncate'
        WHEN kind = 'DELETE' AND NOT regexp_matches(top, '\bWHERE\b', 'i') THEN 'rejected|delete without where'
        WHEN kind = 'DELETE' THEN 'needs_approval|delete with where'
        WHEN kind = 'ALTER' AND regexp_matches(
            sql, '^\s*ALTER\s+TABLE\s+\S+\s+RENAME\s+COLUMN\s+\S+\s+TO\s+\S+\s*;?\s*$', 'i')
            THEN 'auto_executable|column rename'
        WHEN kind = 'ALTER' THEN 'needs_approval|alter other than a column rename'
        WHEN kind = 'UPDATE' THEN 'needs_approval|update'
        WHEN kind = 'INSERT' THEN 'needs_approval|insert'
        WHEN kind = 'SELECT' THEN 'rejected|select fixes nothing'
        ELSE 'rejected|unknown statement type ' || kind END AS verdict
      FROM x_typed)
"""

# --- lineage and memory ----------------------------------------------------------------------------------------------

CTES["x_edges"] = """
SELECT (event_id - 1) // 2 AS parent, event_id AS child FROM events WHERE event_id > 0
UNION ALL
SELECT event_id, (event_id - 1) // 2 FROM events WHERE event_id > 0 AND event_type = 'error'
"""
CTES["x_nodes"] = """
SELECT event_id AS unique_id, CASE WHEN event_id % 3 <> 0 THEN 'model' ELSE 'test' END AS resource_type,
       'model_' || event_id AS name,
       CASE WHEN event_id % 2 = 0 THEN code ELSE '' END AS raw_code,
       CASE WHEN event_id % 5 <> 0 THEN upper(code) END AS compiled_code
FROM (SELECT *, 'select ' || event_type || '_ID, C' || event_id // 4 % 12 || ' from src' AS code FROM events)
"""
CTES["x_sources"] = """
SELECT schema_name, table_name, (max(event_id) - 1) // 2 AS root FROM x_tracked
WHERE event_type <> 'click' AND event_id > 0 GROUP BY ALL
"""
CTES["x_drift"] = """
SELECT schema_name, table_name, root, CASE WHEN len(added) = 1 AND len(removed) = 1 THEN removed[1] END AS column_name
FROM x_diff JOIN x_sources USING (schema_name, table_name)
WHERE has_prior_snapshot AND coalesce(len(added), 0) + coalesce(len(removed), 0) + coalesce(len(changed_types), 0) > 0
"""
CTES["x_vectors"] = f"""
SELECT vec_id AS incident_id, embedding::DOUBLE[] AS vector, vec_id % 2 = 1 AS has_sql_fix,
       'incident ' || vec_id AS summary, 'Fixed like ' || vec_id AS description,
       CASE WHEN vec_id % 3 <> 0 THEN (['low', 'medium', 'high'])[vec_id % 3 + 1] END AS risk_level,
       {statement('vec_id')} AS sql
FROM embeddings
"""
CTES["x_scores"] = """
SELECT n.incident_id AS query_id, o.incident_id AS match_id, list_inner_product(n.vector, o.vector) AS score,
       o.has_sql_fix
FROM x_vectors n JOIN x_vectors o ON o.incident_id < n.incident_id
"""
