"""Incident triage over a table of alerts: parse, classify, gather evidence, choose a fix, route, record.

Every step adds columns and works on all incidents at once. What only a person or an external model can supply (an
error-type label, a proposed fix) is an optional input column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from caselight.functions import labels, logs, statements as st
from caselight.operators.latest import latest_per_key
from caselight.operators.monitors import TABLE_KEY, listed
from caselight.operators.runlog import RUN_KEY

TIMEOUT_MINUTES = 30

# Own wording.
DRIFT = "Columns against the last snapshot: new %s, gone %s, other type or nullability %s. Models below the table: %s%s."
NO_CHECK = "Nothing but past incidents was looked at: no check is made for failures of this kind."
CHECKS = {"schema_drift": "schema_diff,lineage", "volume_anomaly": "row_count", "data_quality": "null_rate",
          "data_corruption": "null_rate,row_count", "freshness": "freshness"}
PAST_INCIDENTS = "past_incidents"

# Wording of messages and of the texts that stand in for missing ones.
NO_LOG = "No error_message found in monitoring.pipeline_runs for dag_id=%s run_id=%s task_id=%s"
SIMILAR = "Found %d similar past incident(s); most similar (score %.2f): %s."
NO_SIMILAR = "No similar past incidents found in memory."
REFERENCING = "; models referencing the changed column: %s"
COUNTS = "Row count check: current=%s baseline=%s deviation=%s%%."
NULLS = "Null-rate check on %s: %d/%d rows (%s%%) are NULL."
FRESHNESS = "Latest freshness check: last_loaded=%s is_stale=%s."
NO_FRESHNESS = "No freshness check recorded yet."
LOGGED_ONLY = "P3 (upstream/infra) — no fix attempted, logged only."
RENAME_SQL = 'ALTER TABLE %s.%s RENAME COLUMN "%s" TO "%s"'
RENAME_NOTE = "Rename column '%s' back to '%s'."
REUSE_NOTE = "Reusing a previously successful fix for a similar incident (similarity %.2f): %s"
INCIDENT_LINE = "[%s/%s] %s.%s (run %s): %s"
INCIDENT_SUMMARY = "%s on %s.%s (run %s)"
NO_SUMMARY = "No investigation summary available."
NO_FIX = "No fix proposed."

FIX_FIELDS = ["source", "description", "risk_level", "sql"]


# --- parse and classify ----------------------------------------------------------------------------------------------

def backfill_logs(alerts: DataFrame, runs: DataFrame) -> DataFrame:
    """Add ``raw_log``: the alert's text, else the message of the latest failed run of its task, else a sentence."""
    failed = latest_per_key(
        runs.where(F.col("status") == "failed").select(*RUN_KEY, "finished_at", "error_message"),
        RUN_KEY, [F.desc_nulls_first("finished_at")],
    ).select(*RUN_KEY, F.col("error_message").alias("__message"))
    sentence = F.format_string(NO_LOG, "dag_id", "run_id", "task_id")
    return alerts.join(failed, RUN_KEY, "left").withColumn(
        "raw_log", F.coalesce(F.nullif("log_text", F.lit("")), F.col("__message"), sentence)
    ).select(*alerts.columns, "raw_log")


def parse_logs(alerts: DataFrame) -> DataFrame:
    """Add ``error_message`` and ``error_type_hint`` from ``raw_log``."""
    return alerts.withColumn("error_message", logs.error_message(F.col("raw_log"))).withColumn(
        "error_type_hint", logs.error_type_hint(F.col("error_message"))
    )


def classify(alerts: DataFrame, label: str | None = None) -> DataFrame:
    """Add ``error_type`` (the label column if there is one, else the hint) and ``severity``."""
    known = F.coalesce(F.col(label), F.col("error_type_hint")) if label else F.col("error_type_hint")
    return alerts.withColumn("error_type", known).withColumn("severity", labels.severity(F.col("error_type")))


# --- evidence --------------------------------------------------------------------------------------------------------

def _optional(df: DataFrame | None, incidents: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Left join of one check result, packed into a struct column ``name``."""
    if df is None:
        return incidents.withColumn(name, F.lit(None))
    packed = df.select(*keys, F.struct(*[c for c in df.columns if c not in keys]).alias(name))
    return incidents.join(packed, keys, "left")


def _or_none(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("None"))


def gather_evidence(
    incidents: DataFrame, *, similar: DataFrame, diffs: DataFrame, counts: DataFrame, nulls: DataFrame,
    freshness: DataFrame, impact: DataFrame,
) -> DataFrame:
    """Add ``tool_used``, ``changed_column``, ``evidence`` (a summary text) and ``details`` (what it was made from, as
    JSON) to incidents with an incident_id and a table.

    The check results hold one row per table (``similar`` one per incident), so each join adds columns and no rows:
    ``diffs`` schema_diff, ``counts`` count_check, ``nulls`` null_rates of one column, ``freshness`` the latest check
    of each table, ``impact`` arrays of models and of models that mention the changed column, ``similar`` n_similar,
    top_score and top_summary.
    """
    joined = _optional(similar, incidents, ["incident_id"], "similar")
    for name, df in (("diff", diffs), ("count", counts), ("null", nulls), ("fresh", freshness), ("impact", impact)):
        joined = _optional(df, joined, TABLE_KEY, name)

    memory = F.when(
        F.coalesce(F.col("similar.n_similar"), F.lit(0)) > 0,
        F.format_string(SIMILAR, "similar.n_similar", F.round("similar.top_score", 2), "similar.top_summary"),
    ).otherwise(NO_SIMILAR)

    single = (F.size("diff.added") == 1) & (F.size("diff.removed") == 1)
    changed = F.when((F.col("error_type") == "schema_drift") & single, F.col("diff.removed")[0])

    def names(path: str) -> Column:
        return listed(F.coalesce(F.col(path), F.array().cast("array<string>")))

    referencing = F.when(changed.isNotNull(), F.format_string(REFERENCING, names("impact.referencing"))).otherwise("")
    drift_text = F.format_string(
        DRIFT, names("diff.added"), names("diff.removed"), names("diff.changed_types"), names("impact.models"), referencing)
    count_text = F.format_string(
        COUNTS, *[_or_none(F.col(f"count.{name}")) for name in ("current_count", "baseline_count", "deviation_pct")])
    null_text = F.when(F.col("null").isNotNull(), F.format_string(
        NULLS, "null.column_name", "null.null_rows", "null.total_rows", F.col("null.null_pct").cast("string")))
    fresh_text = F.when(F.col("fresh").isNotNull(), F.format_string(
        FRESHNESS, _or_none(F.col("fresh.last_loaded")), _or_none(F.col("fresh.is_stale")))).otherwise(NO_FRESHNESS)
    kind = F.col("error_type")
    special = (
        F.when(kind == "schema_drift", drift_text)
        .when(kind == "volume_anomaly", count_text)
        .when(kind == "data_quality", null_text)
        .when(kind == "data_corruption", F.concat_ws(" ", null_text, count_text))
        .when(kind == "freshness", fresh_text)
        .otherwise(NO_CHECK)
    )
    tool = labels.lookup(CHECKS, kind, F.lit(PAST_INCIDENTS))
    only = lambda name, *kinds: F.when(kind.isin(*kinds), F.col(name)).alias(name)
    details = F.to_json(F.struct(
        "similar", only("diff", "schema_drift"), only("impact", "schema_drift"),
        only("count", "volume_anomaly", "data_corruption"), only("null", "data_quality", "data_corruption"),
        only("fresh", "freshness"),
    ))
    return joined.select(
        *incidents.columns, tool.alias("tool_used"), changed.alias("changed_column"),
        F.concat_ws(" ", memory, special).alias("evidence"), details.alias("details"),
    )


# --- fix -------------------------------------------------------------------------------------------------------------

def rename_statement(schema: Column, table: Column, current: Column, canonical: Column) -> Column:
    return F.format_string(RENAME_SQL, schema, table, current, canonical)


def choose_fix(
    incidents: DataFrame, renames: DataFrame, reusable: DataFrame, proposals: DataFrame | None = None
) -> DataFrame:
    """Add ``fix`` (source, description, risk_level, sql), the first that applies of: nothing for P3, a verified rename
    for schema drift, the fix of a similar incident, a proposal from outside, else the mark ``needs_proposal``. Also add
    ``rename_valid`` and ``rename_sql``, the rename that the live schema calls for.

    ``renames`` are rename_candidates per table; ``reusable`` and ``proposals`` hold one row per incident_id with
    description, risk_level and sql (``reusable`` also score).
    """
    ready = renames.where(F.col("current_name").isNotNull()).select(*TABLE_KEY, "current_name", "canonical_name")
    joined = incidents.join(ready, TABLE_KEY, "left")
    joined = _optional(reusable, joined, ["incident_id"], "reuse")
    joined = _optional(proposals, joined, ["incident_id"], "proposal")

    def fix(source: str, description: Column | str, risk: Column | str, sql: Column | None) -> Column:
        as_col = lambda value: F.lit(value) if isinstance(value, str) else value
        return F.struct(
            F.lit(source).alias("source"), as_col(description).alias("description"), as_col(risk).alias("risk_level"),
            (F.lit(None).cast("string") if sql is None else sql).alias("sql"),
        )

    mechanical = fix(
        "mechanical",
        F.format_string(RENAME_NOTE, "current_name", "canonical_name"),
        "low", rename_statement(F.col("schema_name"), F.col("table_name"), F.col("current_name"),
                                F.col("canonical_name")),
    )
    reuse = fix(
        "reuse",
        F.format_string(REUSE_NOTE, F.round("reuse.score", 2), "reuse.description"),
        F.coalesce("reuse.risk_level", F.lit("medium")), F.col("reuse.sql"),
    )
    missing = fix("needs_proposal", F.lit(None).cast("string"), "high", None)
    chosen = (
        F.when(F.col("severity") == "P3", fix("none", LOGGED_ONLY, "low", None))
        .when((F.col("error_type") == "schema_drift") & F.col("current_name").isNotNull(), mechanical)
        .when(F.col("reuse").isNotNull(), reuse)
    )
    if proposals is not None:
        offered = fix("proposal", F.col("proposal.description"), F.col("proposal.risk_level"), F.col("proposal.sql"))
        chosen = chosen.when(F.col("proposal").isNotNull(), offered)
    live = F.col("current_name").isNotNull()
    derived = rename_statement(F.col("schema_name"), F.col("table_name"), F.col("current_name"), F.col("canonical_name"))
    return joined.withColumn("fix", chosen.otherwise(missing)).select(
        *incidents.columns, "fix", live.alias("rename_valid"), F.when(live, derived).alias("rename_sql"))


# --- routing ---------------------------------------------------------------------------------------------------------

def incident_line(description: Column) -> Column:
    kind = F.coalesce("error_type", F.lit("upstream_failure"))
    return F.format_string(
        INCIDENT_LINE, "severity", kind, "dag_id", "task_id", "run_id", F.coalesce(description, F.lit("")))


def route(incidents: DataFrame, allowed: list[str] = st.ALLOWED_TABLES, timeout: int = TIMEOUT_MINUTES) -> DataFrame:
    """Add ``tier``, ``tier_reason``, ``approval_status``, ``fix_executed``, ``timeout_minutes`` and ``actions``.

    The severity picks the strategy and the tier of the proposed statement decides whether it may run. ``actions`` is
    the ordered list of what to do (see ``actions``); nothing is executed here. A rename runs only if ``rename_valid``
    says that it still applies to the live schema, otherwise the task is simply retried.
    """
    severity = F.col("severity")
    p0, p1, p3 = severity == "P0", severity == "P1", severity == "P3"

    def steps(*names: str, told: bool = False) -> Column:
        quiet = F.array(*[F.lit(name) for name in names])
        return F.when(p1, F.array_append(quiet, F.lit("notify"))).otherwise(quiet) if told else quiet

    def decide(audit: Column) -> Column:
        tier = audit["tier"]
        renames = ~p0 & ~p3 & F.coalesce(tier == st.AUTO_EXECUTABLE, F.lit(False)) & F.col("rename_valid")
        waits = ~p0 & ~p3 & F.coalesce(tier == st.NEEDS_APPROVAL, F.lit(False))
        status = (
            F.when(p0, "escalated").when(p3 | tier.isNull(), "auto_approved").when(tier == st.REJECTED, "escalated")
            .when(waits, "pending").otherwise("auto_approved")
        )
        plan = (
            F.when(p0, steps("pause", "notify", "request_approval"))
            .when(p3, steps("log"))
            .when(tier.isNull(), steps("retry", told=True))
            .when(tier == st.REJECTED, steps("notify"))
            .when(renames, steps("apply_rename", "retry", told=True))
            .when(waits, steps("request_approval"))
            .otherwise(steps("retry"))
        )
        return F.struct(
            tier.alias("tier"), audit["reason"].alias("tier_reason"), status.alias("approval_status"),
            renames.alias("fix_executed"),
            F.when(waits & p1, timeout).when(waits | p0, 0).alias("timeout_minutes"), plan.alias("actions"),
        )

    audited = F.when(F.coalesce("fix.sql", F.lit("")) != "", st.classify(F.col("fix.sql"), allowed))
    decided = incidents.withColumn("__decision", st.let(audited, decide))
    return decided.select(*incidents.columns, "__decision.*", incident_line(F.col("fix.description")).alias("line"))


def actions(routed: DataFrame) -> DataFrame:
    """One row per action in order: incident_id, step, action, detail, status."""
    detail = (
        F.when(F.col("action") == "apply_rename", F.col("rename_sql"))  # never the proposed text
        .when((F.col("action") == "request_approval") & F.col("tier_reason").isNotNull(),
              F.concat("line", F.lit("\n("), "tier_reason", F.lit(")")))
        .when((F.col("action") == "notify") & (F.col("tier") == st.REJECTED),
              F.concat("line", F.lit("\nReason: "), "tier_reason", F.lit("\nProposed SQL: "), "fix.sql"))
        .otherwise(F.col("line"))
    )
    # Every incident has an action. The outer form keeps Spark from deriving a filter on the list, which would be pushed
    # down and classify each statement a second time.
    exploded = routed.select("*", F.posexplode_outer("actions").alias("step", "action"))
    return exploded.select("incident_id", "step", "action", detail.alias("detail"),
                           F.col("approval_status").alias("status"))


def approval_requests(routed: DataFrame) -> DataFrame:
    """Requests for the incidents that wait for a person, in the shape ``approvals.request`` takes."""
    waiting = routed.where(F.array_contains("actions", "request_approval"))
    note = F.when(F.col("severity") == "P0", F.col("line")).otherwise(
        F.concat("line", F.lit("\n("), "tier_reason", F.lit(")")))
    return waiting.select(
        "incident_id", "dag_id", "run_id", "task_id", note.alias("summary"), F.col("fix.risk_level").alias("risk_level"),
        "severity", F.when(F.col("severity") != "P0", F.col("fix.sql")).alias("proposed_sql"),
        F.coalesce("timeout_minutes", F.lit(0)).alias("timeout_minutes"),
    )


# --- records ---------------------------------------------------------------------------------------------------------

def approved(status: Column) -> Column:
    """True once applied or approved, false once rejected, null while undecided."""
    return F.when(status.isin("auto_approved", "approved"), True).when(status == "rejected", False)


def incident_records(routed: DataFrame, created_at: Column, allowed: list[str] = st.ALLOWED_TABLES) -> DataFrame:
    """The memory record of each incident. A fix counts as reusable only if its statement really ran."""
    sql = F.nullif("fix.sql", F.lit(""))
    kind = F.coalesce("error_type", F.lit("unknown_error"))
    summary = F.format_string(INCIDENT_SUMMARY, kind, "dag_id", "task_id", "run_id")
    records = routed.select(
        "incident_id", created_at.alias("created_at"), "dag_id", "run_id", "task_id", "error_type", "severity",
        "error_message", summary.alias("summary"),
        F.coalesce(F.nullif("evidence", F.lit("")), F.lit(NO_SUMMARY)).alias("root_cause"),
        F.coalesce(F.nullif("fix.description", F.lit("")), F.lit(NO_FIX)).alias("resolution"),
        F.col("fix.risk_level").alias("risk_level"), "approval_status", sql.alias("sql"), "fix_executed",
    )
    return records.select(
        *[c for c in records.columns if c != "fix_executed"],
        st.tier(F.col("sql"), allowed).alias("sql_tier"),
        (F.col("fix_executed") & F.col("sql").isNotNull()).alias("has_sql_fix"),
        F.concat_ws("\n", "summary", "root_cause", "resolution").alias("embedding_text"),
    )


def incident_reports(records: DataFrame) -> DataFrame:
    """Rows of the reporting table from memory records."""
    return records.select(
        "dag_id", "run_id", "task_id", "error_type",
        F.coalesce(F.nullif("error_message", F.lit("")), F.col("root_cause")).alias("error_message"),
        F.col("resolution").alias("fix_attempted"), F.col("approval_status").alias("fix_result"),
        approved(F.col("approval_status")).alias("approved"), F.col("sql").alias("fix_sql"), "created_at",
    )
