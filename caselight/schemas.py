"""Table and document schemas, as DDL text that every reader and ``createDataFrame`` accepts."""

from __future__ import annotations

# Column names and order of the raw table.
RAW_COLUMNS = [
    "report_id", "received_date", "serious", "serious_death", "serious_hosp", "serious_life", "patient_age",
    "patient_age_unit", "patient_sex", "drug_name", "drug_indication", "reaction", "outcome", "country",
    "loaded_at", "load_date",
]

# Columns a landing file must have.
REQUIRED_COLUMNS = ["report_id", "received_date", "serious", "drug_name", "reaction", "country"]

# Declared text lengths of the raw table.
RAW_LENGTHS = {
    "report_id": 50, "received_date": 20, "serious": 5, "serious_death": 5, "serious_hosp": 5, "serious_life": 5,
    "patient_age_unit": 20, "patient_sex": 5, "drug_name": 500, "drug_indication": 500, "reaction": 500,
    "outcome": 100, "country": 100,
}

RAW_TYPES = {"patient_age": "decimal(10,2)", "loaded_at": "timestamp_ntz", "load_date": "date"}

RAW_DDL = ", ".join(f"{name} {RAW_TYPES.get(name, 'string')}" for name in RAW_COLUMNS)

# A landing file holds the flattened fields as text; typing happens in staging.
LANDING_COLUMNS = [name for name in RAW_COLUMNS if name != "loaded_at"]
LANDING_DDL = ", ".join(f"{name} string" for name in LANDING_COLUMNS)



def _inner(ddl: str) -> str:
    """Column list of a table as the field list of a struct: ``name type`` becomes ``name: type`` at the top level."""
    fields, depth, current = [], 0, ""
    for char in ddl + ",":
        depth += {"<": 1, ">": -1}.get(char, 0)
        if char == "," and depth == 0:
            name, kind = current.strip().split(None, 1)
            fields.append(f"{name}: {kind}")
            current = ""
        else:
            current += char
    return ", ".join(fields)


# Field names of the nested report document. Scalars are read as text so codes keep their spelling.
REPORT_DDL = """
    safetyreportid string,
    receiptdate string,
    serious string,
    seriousnessdeath string,
    seriousnesshospitalization string,
    seriousnesslifethreatening string,
    patient struct<
        patientonsetage: string,
        patientonsetageunit: string,
        patientsex: string,
        drug: array<struct<medicinalproduct: string, drugindication: string>>,
        reaction: array<struct<reactionmeddrapt: string, reactionoutcome: string>>
    >,
    primarysource struct<reportercountry: string>
"""
PAGE_DDL = f"meta struct<results: struct<total: bigint>>, results array<struct<{_inner(REPORT_DDL)}>>"

TASK_RUN_DDL = (
    "dag_id string, run_id string, task_id string, status string, rows_processed bigint, error_message string, "
    "started_at timestamp_ntz, finished_at timestamp_ntz"
)
BASELINE_DDL = "schema_name string, table_name string, scope string, baseline_count bigint, recorded_at timestamp_ntz"
SNAPSHOT_DDL = (
    "schema_name string, table_name string, column_name string, data_type string, is_nullable string, "
    "snapshotted_at timestamp_ntz"
)
FRESHNESS_DDL = (
    "schema_name string, table_name string, last_loaded timestamp_ntz, checked_at timestamp_ntz, is_stale boolean, "
    "data_source string"
)
APPROVAL_DDL = (
    "incident_id string, dag_id string, run_id string, task_id string, summary string, risk_level string, "
    "severity string, proposed_sql string, status string, created_at timestamp_ntz, resolved_at timestamp_ntz, "
    "resolved_by string, escalation_email_sent_at timestamp_ntz, dag_paused_at timestamp_ntz"
)

# Closed vocabularies.
ERROR_TYPES = ["data_corruption", "schema_drift", "volume_anomaly", "data_quality", "freshness", "upstream_failure"]
RISK_LEVELS = ["low", "medium", "high"]
SEVERITIES = ["P0", "P1", "P2", "P3"]
APPROVAL_STATUSES = ["pending", "auto_approved", "escalated", "approved", "rejected"]
