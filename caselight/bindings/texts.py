"""Sample texts that the bindings cycle through."""

DAG_ID = "case_reports_daily"
AS_OF = "2024-03-01 00:00:00"

ERROR_TYPE_CYCLE = [
    "data_corruption", "schema_drift", "volume_anomaly", "data_quality", "freshness", "upstream_failure",
]

LOGS = [
    'Traceback (most recent call last):\n  File "load.py", line 3, in run\n    execute(sql)\n\n'
    'ProgrammingError: column "drug_name" does not exist\n  ',
    "Schema validation FAILED.\nMissing columns: ['drug_name']",
    "  NoSuchKey: the object raw/reports.csv is gone  ",
    "connection refused by host after 3 attempts",
    "table row count deviated 60.0% from baseline",
    "null value in column drug_name violates not-null constraint",
    "something nobody has seen before",
    "\n\n   \n  worker received SIGKILL (Out of memory)\n\n",
]

STATEMENTS = [
    'ALTER TABLE raw.case_reports RENAME COLUMN "medication_name" TO "drug_name"',
    'ALTER TABLE raw.case_reports RENAME COLUMN "medication_name" TO "drug_name";',
    "ALTER TABLE raw.case_reports RENAME COLUMN a TO b; -- done",
    "UPDATE raw.case_reports SET serious = '1;2' WHERE report_id = 'it''s'",
    "DELETE FROM raw.case_reports",
    "DELETE FROM raw.case_reports WHERE drug_name IS NULL",
    "DELETE FROM raw.case_reports USING (SELECT 1 AS a WHERE (1 = 1)) q",
    "SELECT * FROM raw.case_reports",
    "ALTER TABLE raw.case_reports ADD COLUMN dropoff text",
    "truncate raw.case_reports",
    "UPDATE case_reports SET serious = '1'",
    "insert into monitoring.incident_reports (dag_id) values ('where')",
    "UPDATE pg_catalog.pg_class SET relname = 'x' FROM raw.case_reports",
    "   ",
    "WITH bad AS (SELECT report_id FROM raw.case_reports) UPDATE raw.case_reports SET serious = NULL",
    "/* note; */ ALTER TABLE \"raw\".\"case_reports\" ADD COLUMN note text -- x",
    "VACUUM TABLE raw.case_reports",
    "UPDATE raw.case_reports SET a = 1; DELETE FROM raw.case_reports",
    "DELETE FROM raw.case_reports USING (SELECT 1 AS a WHERE " + "(" * 50 + "1 = 1" + ")" * 50 + ") q",
    "UPDATE raw.case_reports SET outcome = '" + "it''s long; " * 600 + "' WHERE report_id = '1'",
    "DELETE FROM raw.case_reports WHERE (drug_name IS NULL",
    "UPDATE raw.case_reports SET outcome = 'x WHERE report_id = 1",
    "DELETE FROM raw.case_reports /* /* */ WHERE 1=1 -- */",
    "DELETE FROM raw.case_reports /* outer /* inner */ still outer */ WHERE 1=1",
    "DELETE FROM raw.case_reports /** a / b **/ WHERE report_id = '1' /* c */",
    "DELETE FROM raw.case_reports /* not closed WHERE 1=1",
    "DELETE FROM raw.case_reports $$ WHERE 1=1 $$",
    "UPDATE raw.case_reports SET outcome = $q$it's; 1 $$ -- x$q$ WHERE report_id = '1'",
    "UPDATE raw.case_reports SET outcome = $q$ open WHERE report_id = '1'",
    r"UPDATE raw.case_reports SET outcome = E'it\'s; 1' WHERE report_id = '1'",
    r"UPDATE raw.case_reports SET outcome = E'\' WHERE report_id = '1",
]
