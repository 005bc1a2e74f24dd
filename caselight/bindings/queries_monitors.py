"""Monitors, drills, renames and changes to tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from caselight.bindings import inputs as b
from caselight.bindings.ctes import day, q, stamp
from caselight.bindings.registry import query
from caselight.bindings.texts import AS_OF
from caselight.operators import changes, drills, monitors, quality, repair
from caselight.plans.ingest import Warehouse
from caselight.plans.monitoring import run_monitors
from caselight.plans.reports import total_records
from caselight.schemas import BASELINE_DDL, FRESHNESS_DDL, RAW_COLUMNS, SNAPSHOT_DDL
from caselight.session import shared_dir
from caselight.sources import tables

# The checks run two and a half days after the first stale table was last loaded.
CHECKED_AT = "2024-02-01 00:00:00"
SPLIT_DAY = "1999-01-01"


# --- row counts and freshness ----------------------------------------------------------------------------------------

@query("row_count_monitor", """
SELECT schema_name, table_name, current_count, baseline_count, round(deviation, 9) AS deviation, deviation_pct, severity FROM x_counts
""")
def row_count_monitor(spark, sf):
    checks = monitors.count_check(b.tracked_stats(spark, sf), b.baselines(spark, sf))
    return checks.withColumn("deviation", F.round("deviation", 9))


@query("row_count_alerts", f"""
SELECT 'row_count_deviation' AS alert_type, severity, schema_name, table_name,
       printf('%s.%s row count deviated %.1f%% from baseline (%d vs %d)', schema_name, table_name,
              round(deviation * 100, 1), current_count, baseline_count) AS message,
       '{{"current_count":' || current_count || ',"baseline_count":' || baseline_count || ',"deviation_pct":'
           || deviation_pct || ',"threshold_pct":30.0}}' AS details,
       '{CHECKED_AT}.000000' AS timestamp
FROM x_counts WHERE severity IS NOT NULL
""")
def row_count_alerts(spark, sf):
    return monitors.count_alerts(monitors.count_check(b.tracked_stats(spark, sf), b.baselines(spark, sf)), CHECKED_AT)


@query("row_count_first_baselines", f"""
SELECT schema_name, table_name, 'table' AS scope, current_count AS baseline_count, '{CHECKED_AT}.000000' AS recorded_at
FROM x_counts WHERE baseline_count IS NULL
""")
def row_count_first_baselines(spark, sf):
    checks = monitors.count_check(b.tracked_stats(spark, sf), b.baselines(spark, sf))
    return monitors.first_baselines(checks, CHECKED_AT)


@query("row_count_any_baseline", """
SELECT schema_name, table_name, current_count, n AS baseline_count,
       round(CASE WHEN n = 0 THEN (current_count > 0)::INT::DOUBLE ELSE abs(current_count - n) / n END, 9) AS deviation
FROM x_stats LEFT JOIN (
    SELECT schema_name, table_name, count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-30') AS n
    FROM x_tracked WHERE table_name <> 'error_3' GROUP BY ALL) USING (schema_name, table_name)
""")
def row_count_any_baseline(spark, sf):
    """The check against the newest baseline of any scope, here the size of the last batch."""
    checks = monitors.count_check(b.tracked_stats(spark, sf), b.baselines(spark, sf), scope=None)
    return checks.select("schema_name", "table_name", "current_count", "baseline_count",
                         F.round("deviation", 9).alias("deviation"))


@query("batch_baseline", f"""
SELECT 'raw' AS schema_name, 'case_reports' AS table_name, 'batch' AS scope, count(*) AS baseline_count,
       '{CHECKED_AT}.000000' AS recorded_at FROM lineitem
""")
def batch_baseline(spark, sf):
    return monitors.batch_baseline("raw", "case_reports", b.raw_reports(spark, sf, reporter=False), CHECKED_AT)


FRESHNESS = f"""
, f AS (SELECT *, epoch(TIMESTAMP '{CHECKED_AT}' - last_loaded) / 3600 AS hours FROM x_stats)
"""


@query("freshness_monitor", FRESHNESS + f"""
SELECT schema_name, table_name, {stamp('last_loaded')} AS last_loaded, '{CHECKED_AT}.000000' AS checked_at,
       round(hours, 6) AS hours_since_load, (hours > 24.2)::VARCHAR AS is_stale FROM f
""")
def freshness_monitor(spark, sf):
    checks = monitors.freshness_check(b.tracked_stats(spark, sf), CHECKED_AT, stale_hours=24.2)
    return checks.withColumn("hours_since_load", F.round("hours_since_load", 6))


@query("freshness_levels", FRESHNESS + """
SELECT table_name, CASE WHEN hours > 24.5 THEN 'error' WHEN hours > 24.2 THEN 'warn' ELSE 'pass' END AS level FROM f
""")
def freshness_levels(spark, sf):
    checks = monitors.freshness_check(b.tracked_stats(spark, sf), CHECKED_AT)
    return monitors.freshness_level(checks, warn=24.2, error=24.5).select("table_name", "level")


@query("freshness_alerts", f"""
, stats AS (SELECT schema_name, table_name, max(ts) FILTER (WHERE table_name <> 'view_2') AS last_loaded FROM x_tracked GROUP BY ALL),
f AS (SELECT *, epoch(TIMESTAMP '{CHECKED_AT}' - last_loaded) / 3600 AS hours FROM stats)
SELECT 'freshness_violation' AS alert_type, 'critical' AS severity, schema_name, table_name,
       CASE WHEN last_loaded IS NULL THEN schema_name || '.' || table_name || ' has no rows / no loaded_at timestamp.'
            ELSE printf('%s.%s last loaded %.1fh ago (threshold: 24h)', schema_name, table_name, round(hours, 1)) END AS message,
       '{{"last_loaded":' || coalesce('"' || strftime(last_loaded, '%Y-%m-%dT%H:%M:%S') || '"', 'null')
           || ',"hours_since_load":' || coalesce(round(hours, 2)::VARCHAR, 'null') || ',"threshold_hours":24}}' AS details,
       '{CHECKED_AT}.000000' AS timestamp
FROM f WHERE coalesce(hours > 24, TRUE)
""")
def freshness_alerts(spark, sf):
    """Alerts for stale tables, one of which has no load time at all."""
    stats = b.tracked_events(spark, sf).groupBy("schema_name", "table_name").agg(
        F.max(F.when(F.col("table_name") != "view_2", F.col("ts"))).alias("last_loaded"))
    return monitors.freshness_alerts(monitors.freshness_check(stats, CHECKED_AT), CHECKED_AT)


# --- schemas ---------------------------------------------------------------------------------------------------------

@query("schema_drift", """
SELECT schema_name, table_name, has_prior_snapshot::VARCHAR AS has_prior_snapshot,
       coalesce(array_to_string(added, ','), '') AS added,
       coalesce(array_to_string(CASE WHEN has_prior_snapshot THEN removed END, ','), '') AS removed,
       coalesce(array_to_string(CASE WHEN has_prior_snapshot THEN changed_types END, ','), '') AS changed_types,
       (has_prior_snapshot AND coalesce(len(added), 0) + coalesce(len(removed), 0) + coalesce(len(changed_types), 0) > 0)::VARCHAR
           AS has_drift
FROM x_diff
""")
def schema_drift(spark, sf):
    return monitors.schema_diff(b.live_columns(spark, sf), monitors.latest_snapshot(b.snapshots(spark, sf)))


@query("schema_drift_alerts", f"""
, l AS (SELECT *, list_transform(coalesce(added, []), lambda c: '''' || c || '''') AS a,
               list_transform(coalesce(removed, []), lambda c: '''' || c || '''') AS r,
               list_transform(coalesce(changed_types, []), lambda c: '''' || c || '''') AS t
        FROM x_diff WHERE has_prior_snapshot)
SELECT 'schema_drift' AS alert_type, 'critical' AS severity, schema_name, table_name,
       'Schema change detected on ' || schema_name || '.' || table_name || ': added=[' || array_to_string(a, ', ')
           || '] removed=[' || array_to_string(r, ', ') || '] changed_types=[' || array_to_string(t, ', ') || ']' AS message,
       replace('{{"added_columns":[' || array_to_string(a, ',') || '],"removed_columns":[' || array_to_string(r, ',')
           || '],"changed_type_columns":[' || array_to_string(t, ',') || ']}}', '''', '"') AS details,
       '{CHECKED_AT}.000000' AS timestamp
FROM l WHERE len(a) + len(r) + len(t) > 0
""")
def schema_drift_alerts(spark, sf):
    return monitors.schema_alerts(schema_drift(spark, sf), CHECKED_AT)


@query("schema_snapshots_due", f"""
SELECT l.*, '{CHECKED_AT}.000000' AS snapshotted_at FROM x_live l JOIN x_diff d USING (schema_name, table_name)
WHERE NOT has_prior_snapshot OR coalesce(len(added), 0) + coalesce(len(removed), 0) + coalesce(len(changed_types), 0) > 0
""")
def schema_snapshots_due(spark, sf):
    return monitors.snapshots_to_record(b.live_columns(spark, sf), schema_drift(spark, sf), CHECKED_AT)


@query("rename_candidates", "SELECT * FROM x_renames")
def rename_candidates(spark, sf):
    return repair.rename_candidates(b.live_columns(spark, sf), b.declared_columns(spark, sf))


@query("alerts_json", """
SELECT '{"alert_type":"row_count_deviation","severity":"' || severity || '","schema_name":"raw","table_name":"' || table_name
       || '","message":"' || printf('%s.%s row count deviated %.1f%% from baseline (%d vs %d)', schema_name, table_name,
              round(deviation * 100, 1), current_count, baseline_count)
       || '","details":"{\\"current_count\\":' || current_count || ',\\"baseline_count\\":' || baseline_count
       || ',\\"deviation_pct\\":' || deviation_pct || ',\\"threshold_pct\\":30.0}","timestamp":"2024-02-01T00:00:00Z"}' AS value
FROM x_counts WHERE severity IS NOT NULL
""")
def alerts_json(spark, sf):
    return monitors.alerts_as_json(row_count_alerts(spark, sf))


@query("run_checks", f"""
, t(table_name, n, newest) AS (
    SELECT 'raw_reports', count(*), max(loaded_at) FROM x_raw UNION ALL SELECT 'events', count(*), max(ts) FROM events
    UNION ALL SELECT 'approvals', count(*), max(created_at) FROM x_approvals),
known(table_name, base) AS (
    SELECT 'raw_reports', count(*) FROM x_raw WHERE loaded_at < TIMESTAMP '{SPLIT_DAY}' UNION ALL SELECT 'events', count(*) FROM events WHERE event_id % 4 = 0),
checks AS (SELECT *, abs(n - base) / base AS deviation FROM t LEFT JOIN known USING (table_name))
SELECT 'row_count_deviation' AS alert_type, table_name, CASE WHEN deviation > 0.5 THEN 'critical' ELSE 'warning' END AS severity,
       printf('raw.%s row count deviated %.1f%% from baseline (%d vs %d)', table_name, round(deviation * 100, 1), n, base) AS message
FROM checks WHERE deviation > 0.3
UNION ALL
SELECT 'freshness_violation', table_name, 'critical',
       printf('raw.%s last loaded %.1fh ago (threshold: 24h)', table_name,
              round(epoch(TIMESTAMP '2024-03-01 00:00:00' - newest) / 3600, 1))
FROM checks WHERE epoch(TIMESTAMP '2024-03-01 00:00:00' - newest) / 3600 > 24
UNION ALL
SELECT 'schema_drift', 'events', 'critical',
       'Schema change detected on raw.events: added=[''loaded_at'', ''user_id'', ''value''] removed=[''gone''] changed_types=[''props'']'
""")
def run_checks(spark, sf):
    """All three monitors over three live tables in one go."""
    tables = {
        "raw_reports": b.raw_reports(spark, sf, reporter=False),
        "events": b.table(spark, sf, "events").withColumnRenamed("ts", "loaded_at"),
        "approvals": b.approvals(spark, sf).withColumnRenamed("created_at", "loaded_at"),
    }
    before = {"raw_reports": tables["raw_reports"].where(F.col("loaded_at") < SPLIT_DAY),
              "events": tables["events"].where(F.col("event_id") % 4 == 0)}
    unknown = spark.createDataFrame([], BASELINE_DDL)
    known = monitors.first_baselines(
        monitors.count_check(monitors.table_stats(before, "raw"), unknown), "2024-01-01")
    previous = spark.createDataFrame(
        [("raw", "events", name, kind, "YES") for name, kind in
         [("event_id", "bigint"), ("event_type", "string"), ("props", "bigint"), ("gone", "string")]],
        "schema_name string, table_name string, column_name string, data_type string, is_nullable string",
    ).withColumn("snapshotted_at", monitors.moment("2024-01-01"))
    found = monitors.run_checks(tables, "raw", known, previous, AS_OF)
    return found["alerts"].select("alert_type", "table_name", "severity", "message")


@query("monitor_job", """
, t(table_name, n) AS (SELECT 'events', count(*) FROM events UNION ALL SELECT 'orders', count(*) FROM orders),
later(table_name, n) AS (SELECT 'events', count(*) FROM events WHERE event_id % 4 = 0 UNION ALL SELECT 'orders', count(*) FROM orders)
SELECT 'baseline' AS kind, table_name, n AS value FROM t
UNION ALL SELECT 'freshness', table_name, 2 FROM t
UNION ALL SELECT 'snapshot', 'events', 4 + 3
UNION ALL SELECT 'snapshot', 'orders', count(*) FROM (DESCRIBE orders)
UNION ALL SELECT 'alert row_count_deviation', 'events', 1
UNION ALL SELECT 'alert schema_drift', 'events', 1
UNION ALL SELECT 'alert freshness_violation', table_name, 2 FROM t
UNION ALL SELECT 'failed', 'broken', 2
""")
def monitor_job(spark, sf):
    """The monitor job twice over stored logs, the second time over a table that lost rows and a column; a table that
    cannot be read takes no other check with it. The second run is repeated, which changes nothing."""
    warehouse = Warehouse(f"{shared_dir(spark, 'monitors')}/warehouse")
    events = b.table(spark, sf, "events").select("event_id", F.col("ts").alias("loaded_at"), "event_type", "value")
    orders = b.table(spark, sf, "orders").withColumn("loaded_at", F.to_timestamp_ntz("o_orderdate")).drop("o_comment")
    names = b.table(spark, sf, "orders").columns
    orders = orders.select(*names[:-1], F.col("loaded_at").alias(names[-1])).withColumnRenamed(names[-1], "loaded_at")
    broken = events.withColumn("loaded_at", F.raise_error(F.lit("cannot be read")).cast("timestamp_ntz"))
    watched = {"events": events, "orders": orders, "broken": broken}
    smaller = watched | {"events": events.where(F.col("event_id") % 4 == 0).drop("value")}
    failed = []
    for run, found, at in (("1", watched, AS_OF), ("2", smaller, "2024-03-01 01:00:00"), ("2", smaller, "2024-03-01 01:00:00")):
        failed.append(run_monitors(spark, warehouse, found, "raw", at, run))
    log = lambda name, ddl: tables.read_log(spark, warehouse.path("monitoring", name), ddl)
    counted = lambda df, kind: df.groupBy("table_name").agg(F.count(F.lit(1)).alias("value")).select(
        F.lit(kind).alias("kind"), "table_name", "value")
    alerts = log("alerts", "alert_type string, severity string, schema_name string, table_name string, message string")
    per_alert = alerts.groupBy(F.concat(F.lit("alert "), F.col("alert_type")).alias("kind"), "table_name").agg(
        F.count(F.lit(1)).alias("value"))
    bad = spark.createDataFrame([("failed", name) for names in failed[:2] for name in names], "kind string, table_name string")
    return (log("row_count_baselines", BASELINE_DDL).select(F.lit("baseline").alias("kind"), "table_name", F.col("baseline_count").alias("value"))
            .unionByName(counted(log("freshness_checks", FRESHNESS_DDL), "freshness"))
            .unionByName(counted(log("schema_snapshots", SNAPSHOT_DDL).where("table_name <> 'broken'"), "snapshot")).unionByName(per_alert)
            .unionByName(bad.groupBy("kind", "table_name").agg(F.count(F.lit(1)).alias("value"))))


# --- drills ----------------------------------------------------------------------------------------------------------

SEED = 7


def _ranked(seed: int, size: str, name: str = "hit") -> str:
    """SQL condition: the row is among the ``size`` smallest key digests."""
    return f"row_number() OVER (ORDER BY md5(report_id || '|{seed}')) <= {size} AS {name}"


COUNT = "(SELECT count(*) FROM x_loaded)"


@query("drill_volume", f"""
SELECT report_id, source_row FROM (SELECT *, {_ranked(SEED, f'ceil({COUNT} * 0.6)')} FROM x_loaded) WHERE NOT hit
""")
def drill_volume(spark, sf):
    loaded = b.loaded_reports(spark, sf, reporter=False)
    return drills.drop_rows(loaded, ["report_id"], SEED).select("report_id", "source_row")


@query("drill_volume_floor", f"""
SELECT report_id, source_row FROM (SELECT *, {_ranked(SEED, f'floor({COUNT} * 0.6)')} FROM x_loaded) WHERE NOT hit
""")
def drill_volume_floor(spark, sf):
    loaded = b.loaded_reports(spark, sf, reporter=False)
    return drills.drop_rows(loaded, ["report_id"], SEED, rounding="floor").select("report_id", "source_row")


@query("drill_data_quality", f"""
SELECT report_id, CASE WHEN NOT a THEN drug_name END AS drug_name, CASE WHEN b THEN '-999' ELSE serious END AS serious
FROM (SELECT *, {_ranked(SEED, f'greatest(1, floor({COUNT} * 0.1))', 'a')},
             {_ranked(SEED + 1, f'greatest(1, floor({COUNT} * 0.05))', 'b')} FROM x_loaded)
""")
def drill_data_quality(spark, sf):
    loaded = b.loaded_reports(spark, sf, reporter=False)
    return drills.run_drill("data_quality", loaded, ["report_id"], AS_OF, SEED).select("report_id", "drug_name", "serious")


@query("drill_freshness", f"""
SELECT report_id, {stamp(f"TIMESTAMP {q(AS_OF)} - INTERVAL 3 DAYS")} AS loaded_at FROM x_loaded
""")
def drill_freshness(spark, sf):
    loaded = b.loaded_reports(spark, sf, reporter=False)
    return drills.run_drill("freshness_failure", loaded, ["report_id"], AS_OF).select("report_id", "loaded_at")


@query("drill_schema_repaired", """
SELECT report_id, drug_name, 'Renamed column ''drug_brand_nm'' back to ''drug_name''.' AS note FROM x_loaded
""")
def drill_schema_repaired(spark, sf):
    """A moved column is found by its schema alone and named back."""
    loaded = b.loaded_reports(spark, sf).drop("source_row")
    broken = drills.run_drill("schema_drift", loaded, ["report_id"], AS_OF)
    repaired, note = repair.apply_safe_rename(broken)
    return repaired.select("report_id", "drug_name", F.lit(note).alias("note"))


@query("drill_detection", f"""
SELECT count(*) AS current_count, {COUNT} AS baseline_count, 'critical' AS severity,
       count(*) FILTER (WHERE a) AS null_drug_names, count(*) FILTER (WHERE b) AS bad_codes
FROM (SELECT *, {_ranked(SEED, f'ceil({COUNT} * 0.6)')} FROM x_loaded)
JOIN (SELECT report_id, drug_name IS NULL OR {_ranked(SEED, f'greatest(1, floor({COUNT} * 0.1))', 'x').removesuffix(' AS x')} AS a,
             {_ranked(SEED + 1, f'greatest(1, floor({COUNT} * 0.05))', 'b')} FROM x_loaded) USING (report_id)
WHERE NOT hit
""")
def drill_detection(spark, sf):
    """Two drills on one table and what the monitors say: the count alert and the failures of the rules."""
    loaded = b.loaded_reports(spark, sf, reporter=False)
    key = ["report_id"]
    damaged = drills.run_drills(["data_quality", "volume_anomaly"], loaded, key, AS_OF, SEED)
    checks = monitors.count_check(
        damaged.agg(F.count(F.lit(1)).alias("current_count")).select(
            F.lit("raw").alias("schema_name"), F.lit("case_reports").alias("table_name"), "current_count"),
        total_records(loaded).select(
            F.lit("raw").alias("schema_name"), F.lit("case_reports").alias("table_name"), F.lit("table").alias("scope"),
            F.col("total").alias("baseline_count"), monitors.moment(AS_OF).alias("recorded_at")),
    )
    rules = [quality.not_null("drug_name"), quality.accepted_values("serious", ["1", "2"])]
    failures = quality.run_rules(damaged, rules, "case_reports").groupBy("table_name").agg(
        F.max(F.when(F.col("rule") == "not_null", F.col("failures"))).alias("null_drug_names"),
        F.max(F.when(F.col("rule") == "accepted_values", F.col("failures"))).alias("bad_codes"))
    return checks.join(failures, "table_name").select(
        "current_count", "baseline_count", "severity", "null_drug_names", "bad_codes")


# --- changes ---------------------------------------------------------------------------------------------------------



@query("upsert_reports", f"""
, old AS (SELECT * FROM x_raw WHERE loaded_at < DATE '{SPLIT_DAY}'
          QUALIFY row_number() OVER (PARTITION BY report_id ORDER BY loaded_at DESC, source_row DESC) = 1),
new AS (SELECT * REPLACE (TIMESTAMP {q(AS_OF)} AS loaded_at) FROM x_raw WHERE loaded_at >= DATE '{SPLIT_DAY}'
        QUALIFY row_number() OVER (PARTITION BY report_id ORDER BY x_raw.loaded_at DESC, source_row DESC) = 1)
SELECT report_id, received_date, serious, drug_name, outcome, source_row, {stamp('loaded_at')} AS loaded_at, {day('load_date')} AS load_date
FROM (SELECT * FROM old WHERE report_id NOT IN (SELECT report_id FROM new) UNION ALL SELECT * FROM new)
""")
def upsert_reports(spark, sf):
    """Reports up to a day are the table, later ones the batch."""
    raw = b.raw_reports(spark, sf, reporter=False)
    target = changes.dedupe_batch(raw.where(F.col("loaded_at") < SPLIT_DAY), ["report_id"], b.last_wins())
    batch = raw.where(F.col("loaded_at") >= SPLIT_DAY)
    merged = changes.upsert(target, batch, ["report_id"], b.last_wins(), loaded_at=AS_OF)
    return merged.select("report_id", "received_date", "serious", "drug_name", "outcome", "source_row", "loaded_at", "load_date")


APPROVAL_OUT = f"""
incident_id, dag_id, run_id, task_id, summary, risk_level, severity, proposed_sql, status, {stamp('created_at')} AS created_at,
{stamp('resolved_at')} AS resolved_at, resolved_by, {stamp('escalation_email_sent_at')} AS escalation_email_sent_at,
{stamp('dag_paused_at')} AS dag_paused_at
"""


@query("delete_keys", f"""
SELECT {APPROVAL_OUT} FROM x_approvals WHERE incident_id NOT IN (SELECT incident_id FROM x_decisions)
""")
def delete_keys(spark, sf):
    return changes.delete_keys(b.approvals(spark, sf), b.decisions(spark, sf).select("incident_id").distinct(), ["incident_id"])


@query("update_where", f"""
SELECT {APPROVAL_OUT.replace('risk_level', "CASE WHEN d.action IS NOT NULL THEN 'high' ELSE risk_level END AS risk_level")}
FROM x_approvals LEFT JOIN x_last_decisions d USING (incident_id)
""")
def update_where(spark, sf):
    keys = b.decisions(spark, sf).select("incident_id").distinct()
    return changes.update_where(b.approvals(spark, sf), keys, ["incident_id"], {"risk_level": F.lit("high")})


@query("replace_slice", """
SELECT table_name, column_name, data_type, '2024-02-05 00:00:00.000000' AS snapshotted_at FROM x_declared
WHERE table_name NOT LIKE 'view%' AND table_name NOT LIKE '%1'
UNION ALL
SELECT table_name, column_name, data_type, '2024-01-05 00:00:00.000000' FROM x_declared
WHERE table_name NOT LIKE 'view%' AND table_name NOT LIKE '%1' AND column_name <> 'c1'
UNION ALL
SELECT table_name, column_name, data_type, '2024-03-01 00:00:00.000000' FROM x_live WHERE table_name LIKE '%1'
""")
def replace_slice(spark, sf):
    """The snapshots of some tables are replaced by their live columns, the others keep theirs."""
    live = b.live_columns(spark, sf).where(F.col("table_name").endswith("_1"))
    fresh = live.withColumn("snapshotted_at", monitors.moment(AS_OF))
    kept = changes.replace_slice(b.snapshots(spark, sf), fresh, ["schema_name", "table_name"])
    return kept.select("table_name", "column_name", "data_type", "snapshotted_at")


@query("restore_after_drill", """
SELECT report_id, drug_name, serious, received_date FROM x_loaded
""")
def restore_after_drill(spark, sf):
    """A stored table loses rows and a column; the snapshot stored before gives back every row as it was."""
    root = shared_dir(spark, "drill")
    tables.rebuild(b.loaded_reports(spark, sf), f"{root}/live")
    live = spark.read.parquet(f"{root}/live")
    tables.snapshot_once(live, f"{root}/backup")
    damaged = drills.run_drills(["volume_anomaly", "data_quality", "schema_drift"], live, ["report_id"], AS_OF)
    tables.rebuild(damaged, f"{root}/damaged")
    hurt = spark.read.parquet(f"{root}/damaged")
    assert hurt.columns != RAW_COLUMNS
    restored = drills.restore(tables.snapshot_once(hurt, f"{root}/backup"))
    tables.rebuild(restored, f"{root}/damaged")
    return spark.read.parquet(f"{root}/damaged").select("report_id", "drug_name", "serious", "received_date")
