"""Approval requests, decisions and the escalation ladder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from caselight.functions import statements as st
from caselight.functions.measures import minutes_between, moment
from caselight.operators.audit import audited
from caselight.operators.changes import update_where, upsert_columns
from caselight.operators.incidents import TIMEOUT_MINUTES
from caselight.operators.latest import latest_per_key

REQUEST_COLUMNS = ["summary", "risk_level", "severity", "proposed_sql"]
TIMEOUT_RESOLVER = "escalation_timeout"

# Headlines of requests.
URGENT = "P0 — DAG PAUSED — urgent response required"
TIMED = "P1 — will auto-apply in %d min if unanswered"
HIGH_RISK = "HIGH RISK — do not auto-apply"
REVIEW = "Review needed"


def request(approvals: DataFrame, requests: DataFrame, order: list[Column], at) -> DataFrame:
    """Add requests as pending; a repeated request refreshes its four request columns and keeps status and times."""
    return upsert_columns(
        approvals, requests, ["incident_id"], REQUEST_COLUMNS, order,
        {"status": F.lit("pending"), "created_at": moment(at)},
    )


def decide(approvals: DataFrame, decisions: DataFrame, order: list[Column], at) -> DataFrame:
    """Record decisions (incident_id, action, username): ``approve`` approves, any other action rejects."""
    last = latest_per_key(decisions, ["incident_id"], order)
    return update_where(approvals, last, ["incident_id"], {
        "status": F.when(F.col("action") == "approve", "approved").otherwise("rejected"),
        "resolved_at": moment(at),
        "resolved_by": F.coalesce("username", F.lit("unknown")),
    })


def fix_steps(approved: DataFrame, allowed: list[str] = st.ALLOWED_TABLES) -> DataFrame:
    """What to do for approved incidents (severity, proposed_sql): add ``step``.

    P0 approvals are only acknowledged. For P1 and P2 the statement is classified again: a refused one is not run, a
    rename is derived anew from the live schema, anything else runs as approved; no statement means a plain retry.
    """
    acts = F.coalesce(F.col("severity").isin("P1", "P2"), F.lit(False))
    judged = audited(approved, F.when(acts, F.col("proposed_sql")), "__audit", allowed)
    step = step_of(F.col("proposed_sql"), F.col("__audit.tier"))
    return judged.withColumn("step", F.when(acts, step).otherwise("acknowledge")).drop("__audit")


def step_of(sql: Column, tier: Column) -> Column:
    """What to do with a statement that may run now, given the tier of a fresh audit."""
    return (
        F.when(F.coalesce(sql, F.lit("")) == "", "retry")
        .when(tier == st.REJECTED, "refuse")
        .when(tier == st.AUTO_EXECUTABLE, "apply_rename_and_retry")
        .otherwise("run_statement_and_retry")
    )


def timeout_step(action: Column, sql: Column, allowed: list[str] = st.ALLOWED_TABLES) -> Column:
    """The step of an ``auto_apply``, null for other actions: nobody looked at the statement, so it is audited again."""
    return F.when(action == "auto_apply", st.let(st.tier(sql, allowed), lambda known: step_of(sql, known)))


def status_of(wanted: DataFrame, approvals: DataFrame) -> DataFrame:
    """Status of each wanted incident_id; ``unknown`` when it was never requested."""
    known = approvals.select("incident_id", "status", "resolved_at", "resolved_by")
    return wanted.join(known, ["incident_id"], "left").withColumn("status", F.coalesce("status", F.lit("unknown")))


def urgency(severity: Column, timeout_minutes: Column, risk_level: Column) -> Column:
    """Headline of a request."""
    return (
        F.when(severity == "P0", URGENT)
        .when((severity == "P1") & (timeout_minutes > 0), F.format_string(TIMED, timeout_minutes))
        .when(risk_level == "high", HIGH_RISK)
        .otherwise(REVIEW)
    )


def due_actions(
    severity: Column, age_minutes: Column, mail_sent: Column, dag_paused: Column, timeout: int = TIMEOUT_MINUTES
) -> Column:
    """Ordered actions due for a pending approval; two can be due at once."""
    apply = (severity == "P1") & (age_minutes >= timeout)
    mail = (severity == "P0") & mail_sent.isNull() & (age_minutes >= timeout)
    pause = (severity == "P0") & dag_paused.isNull() & (age_minutes >= 2 * timeout)
    return F.array_compact(F.array(
        F.when(apply, "auto_apply"), F.when(mail, "send_mail"), F.when(pause, "pause_dag")
    ))


def ladder(
    approvals: DataFrame, as_of, timeout: int = TIMEOUT_MINUTES, allowed: list[str] = st.ALLOWED_TABLES
) -> DataFrame:
    """One row per action due at ``as_of`` among pending approvals; ``step`` says what an ``auto_apply`` really does."""
    age = minutes_between(F.col("created_at"), moment(as_of))
    due = due_actions(F.col("severity"), age, F.col("escalation_email_sent_at"), F.col("dag_paused_at"), timeout)
    pending = approvals.where(F.col("status") == "pending")
    found = pending.select(
        "incident_id", "severity", age.alias("age_minutes"), "proposed_sql", F.explode(due).alias("action"))
    applies = F.col("action") == "auto_apply"
    judged = audited(found, F.when(applies, F.col("proposed_sql")), "__audit", allowed)
    step = F.when(applies, step_of(F.col("proposed_sql"), F.col("__audit.tier")))
    return judged.withColumn("step", step).drop("proposed_sql", "__audit")


def climb(
    approvals: DataFrame, as_of, timeout: int = TIMEOUT_MINUTES, allowed: list[str] = st.ALLOWED_TABLES
) -> DataFrame:
    """The approvals table after the due actions of ``ladder`` were taken at ``as_of``.

    A request whose statement the audit refuses is closed as ``refused``: nothing ran, so no report counts it as healed.
    """
    age = minutes_between(F.col("created_at"), moment(as_of))
    due = F.when(
        F.col("status") == "pending",
        due_actions(F.col("severity"), age, F.col("escalation_email_sent_at"), F.col("dag_paused_at"), timeout),
    )
    took = lambda action: F.coalesce(F.array_contains("__due", action), F.lit(False))
    applied = took("auto_apply")
    judged = audited(approvals.withColumn("__due", due), F.when(applied, F.nullif("proposed_sql", F.lit(""))), "__audit", allowed)
    refused = (F.coalesce("proposed_sql", F.lit("")) != "") & (F.col("__audit.tier") == st.REJECTED)
    return judged.withColumns({
        "status": F.when(applied & refused, "refused").when(applied, "auto_approved").otherwise(F.col("status")),
        "resolved_at": F.when(applied, moment(as_of)).otherwise(F.col("resolved_at")),
        "resolved_by": F.when(applied, TIMEOUT_RESOLVER).otherwise(F.col("resolved_by")),
        "escalation_email_sent_at": F.when(took("send_mail"), moment(as_of)).otherwise(
            F.col("escalation_email_sent_at")),
        "dag_paused_at": F.when(took("pause_dag"), moment(as_of)).otherwise(F.col("dag_paused_at")),
    }).drop("__due", "__audit")
