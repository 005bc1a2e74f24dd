"""Sources, stored tables and streams."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from caselight.bindings import inputs as b
from caselight.bindings.ctes import hint, q, severity, stamp
from caselight.bindings.queries_monitors import CHECKED_AT, SPLIT_DAY
from caselight.bindings.registry import query
from caselight.bindings.saved_pages import fetch_saved
from caselight.bindings.texts import AS_OF, STATEMENTS
from caselight.operators import changes, monitors, quality
from caselight.operators.audit import audit
from caselight.plans import monitoring
from caselight.plans.ingest import Warehouse, build_models, load_batch, run_load, task_runs
from caselight.schemas import LANDING_COLUMNS
from caselight.session import shared_dir, short_lived_shuffles
from caselight.sources import landing, paged, reports, tables, windows
from caselight.streaming import checks, ingest, jobs, ladder
from caselight.streaming.windows import load_counts

LOAD_DATE = "2024-03-01"

# --- documents -------------------------------------------------------------------------------------------------------

FLAT = f"""
, lines AS (
    SELECT l_orderkey, arg_min(p_name, (l_linenumber, l_shipdate, l_partkey)) AS drug,
           arg_min(p_type, (l_linenumber, l_shipdate, l_partkey)) AS use,
           arg_min(p_brand, (l_linenumber, l_shipdate, l_partkey)) AS effect, min(l_linenumber) AS line
    FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey),
flat AS (
    SELECT o_orderkey::VARCHAR AS report_id, strftime(o_orderdate, '%Y%m%d') AS received_date,
           CASE o_orderstatus WHEN 'F' THEN '1' ELSE '2' END AS serious, CASE o_orderstatus WHEN 'P' THEN '1' END AS serious_death,
           NULL::VARCHAR AS serious_hosp, NULL::VARCHAR AS serious_life,
           CASE WHEN o_orderkey % 11 <> 0 AND o_orderkey % 4 <> 0 THEN (o_orderkey % 90)::VARCHAR END AS patient_age,
           CASE WHEN o_orderkey % 11 <> 0 THEN '801' END AS patient_age_unit,
           CASE WHEN o_orderkey % 11 <> 0 THEN (o_orderkey % 2 + 1)::VARCHAR END AS patient_sex,
           CASE WHEN o_orderkey % 11 <> 0 THEN drug END AS drug_name,
           CASE WHEN o_orderkey % 11 <> 0 THEN use END AS drug_indication,
           CASE WHEN o_orderkey % 11 <> 0 THEN effect END AS reaction,
           CASE WHEN o_orderkey % 11 <> 0 THEN (line % 3 + 1)::VARCHAR END AS outcome,
           CASE WHEN o_orderkey % 13 <> 0 THEN o_orderpriority END AS country,
           '{LOAD_DATE}' AS load_date, o_orderdate
    FROM orders LEFT JOIN lines ON l_orderkey = o_orderkey)
"""
FLAT_COLUMNS = ", ".join(LANDING_COLUMNS)


@query("flatten_reports", FLAT + f"SELECT {FLAT_COLUMNS} FROM flat")
def flatten_reports(spark, sf):
    return reports.flatten(reports.parse_documents(b.nested_reports(spark, sf)), LOAD_DATE)


def _pages(spark, sf):
    """Page envelopes of a hundred documents by year, as a paged service would send them."""
    nested = b.nested_reports(spark, sf).withColumn("page", F.floor(F.col("report_no") / 100))
    packed = nested.groupBy("year", "page").agg(F.sort_array(F.collect_list("json")).alias("documents"))
    return packed.select("year", "page", F.concat(
        F.lit('{"meta":{"results":{"total":'), F.size("documents").cast("string"), F.lit('}},"results":['),
        F.array_join("documents", ","), F.lit("]}")).alias("envelope"))


@query("explode_pages", FLAT + f"SELECT {FLAT_COLUMNS} FROM flat")
def explode_pages(spark, sf):
    return reports.flatten(reports.explode_pages(_pages(spark, sf), "envelope"), LOAD_DATE)


@query("page_totals", """
SELECT year, sum(total)::BIGINT AS total FROM (
    SELECT year(o_orderdate) AS year, o_orderkey // 100 AS page, count(*) AS total FROM orders GROUP BY ALL) GROUP BY year
""")
def page_totals(spark, sf):
    return _pages(spark, sf).groupBy("year").agg(F.sum(reports.page_total(F.col("envelope"))).alias("total"))


# --- windows and cursor ----------------------------------------------------------------------------------------------

FIRST_WINDOW = "receiptdate:[20200401 TO 20210401]"


def _daily_totals(spark, sf):
    """Rows per day of each yearly window back from the first one; orders stand for the reports of the service."""
    day = F.col("o_orderdate")
    counts = b.table(spark, sf, "orders").groupBy(
        (F.year(day) - F.when(F.month(day) < 4, 1).otherwise(0)).alias("start_year"), day.alias("day")).agg(
        F.count(F.lit(1)).alias("total"))
    return windows.windows_back(spark, FIRST_WINDOW, earliest=1994).join(counts, "start_year", "left")


def _window_totals(spark, sf):
    return _daily_totals(spark, sf).groupBy("position", "date_range", "start_year").agg(
        F.coalesce(F.sum("total"), F.lit(0)).alias("total"))


WINDOWS = """
, sizes AS (SELECT year(o_orderdate) - (month(o_orderdate) < 4)::INT AS y, count(*) AS n FROM orders GROUP BY y),
w AS (SELECT 2020 - y AS position, printf('receiptdate:[%d0401 TO %d0401]', y, y + 1) AS date_range, y AS start_year,
             coalesce(n, 0) AS total FROM range(1994, 2021) r(y) LEFT JOIN sizes USING (y))
"""


@query("window_totals", WINDOWS + "SELECT position::BIGINT AS position, date_range, start_year::BIGINT AS start_year, total FROM w")
def window_totals(spark, sf):
    return _window_totals(spark, sf)


@query("window_plan", WINDOWS + """
, daily AS (
    SELECT date_range, total AS whole, o_orderdate AS d, count(*) AS n
    FROM orders JOIN w ON start_year = year(o_orderdate) - (month(o_orderdate) < 4)::INT GROUP BY ALL),
running AS (
    SELECT *, max(n) OVER (PARTITION BY date_range) AS most, sum(n) OVER (PARTITION BY date_range ORDER BY d) - n AS before FROM daily),
fitted AS (
    SELECT CASE WHEN whole <= 25000 THEN date_range
                ELSE 'receiptdate:[' || strftime(min(d), '%Y%m%d') || ' TO ' || strftime(max(d), '%Y%m%d') || ']' END AS date_range, sum(n) AS total
    FROM running GROUP BY running.date_range, whole, CASE WHEN whole > 25000 THEN before // (25000 - most) END)
SELECT date_range, unnest(range(0, total::BIGINT, 100)) AS skip, 100::BIGINT AS "limit" FROM fitted
""")
def window_plan(spark, sf):
    return windows.page_plan(windows.fit_windows(_daily_totals(spark, sf).where("day is not null").select(
        "date_range", "day", "total")))


YEAR_WINDOW = "receiptdate:[20010101 TO 20011231]"
SERVED = """
, served AS (SELECT *, year(o_orderdate) AS y, row_number() OVER (PARTITION BY year(o_orderdate) ORDER BY report_id::BIGINT) - 1 AS n FROM flat)
"""


# The saved pages stand for a service without a limit of its own.
NO_CAP = str(10**12)


@query("paged_run", FLAT + SERVED + f"SELECT {FLAT_COLUMNS} FROM served WHERE y = 2001 AND n >= 250")
def paged_run(spark, sf):
    """The paged source as a batch: from a cursor to the end of its window, fetched by executors."""
    folder = shared_dir(spark, "pages")
    b.save_pages(spark, sf, folder)
    paged.register(spark, fetch_saved)
    pages = spark.read.format("paged_reports").options(
        folder=folder, date_range=YEAR_WINDOW, skip=250, pages_per_task=3, cap=NO_CAP).load()
    return reports.flatten(reports.explode_pages(pages), LOAD_DATE)


@query("paged_stream", FLAT + SERVED + f"SELECT {FLAT_COLUMNS} FROM served WHERE y < 2001 OR y = 2001 AND n >= 250")
def paged_stream(spark, sf):
    """The paged source as a stream: from a cursor to the end of its window and on through the years before."""
    folder = shared_dir(spark, "pages")
    b.save_pages(spark, sf, folder)
    paged.register(spark, fetch_saved)
    documents = ingest.page_stream(spark, {
        "folder": folder, "date_range": YEAR_WINDOW, "skip": "250", "earliest_year": "1990", "cap": NO_CAP})
    return jobs.drain(reports.flatten(documents, LOAD_DATE), "paged")


# --- landing files and stored tables ---------------------------------------------------------------------------------

@query("landing_files", FLAT + f"""
SELECT {FLAT_COLUMNS} FROM flat WHERE o_orderdate >= DATE '{SPLIT_DAY}'
""")
def landing_files(spark, sf):
    """Two batches land as CSV; the newest one is found by its name and read back."""
    path = shared_dir(spark, "landing")
    flat = reports.flatten(reports.parse_documents(b.nested_reports(spark, sf)), LOAD_DATE)
    early = F.col("received_date") < SPLIT_DAY.replace("-", "")
    landing.write_landing(flat.where(early), path, "2024-02-29", "0001")
    landing.write_landing(flat.where(~early), path, LOAD_DATE, "0001")
    load_date, batch_id = landing.latest_batch(spark, path)
    batch = landing.lower_names(landing.read_batch(spark, path, load_date, batch_id))
    return quality.require_columns(batch, LANDING_COLUMNS).select(*LANDING_COLUMNS)


KEYED = f"""
, old AS (SELECT * FROM x_raw WHERE loaded_at < DATE '{SPLIT_DAY}'
          QUALIFY row_number() OVER (PARTITION BY report_id ORDER BY loaded_at DESC, source_row DESC) = 1),
new AS (SELECT * REPLACE (TIMESTAMP {q(AS_OF)} AS loaded_at) FROM x_raw WHERE loaded_at >= DATE '{SPLIT_DAY}'
        QUALIFY row_number() OVER (PARTITION BY report_id ORDER BY x_raw.loaded_at DESC, source_row DESC) = 1)
"""


@query("keyed_table", KEYED + f"""
SELECT report_id, received_date, drug_name, source_row, {stamp('loaded_at')} AS loaded_at
FROM (SELECT * FROM old WHERE report_id NOT IN (SELECT report_id FROM new) UNION ALL SELECT * FROM new)
""")
def keyed_table(spark, sf):
    """The upsert of ``upsert_reports`` on a stored table, run twice to the same end."""
    table = tables.KeyedTable(f"{shared_dir(spark, 'keyed')}/reports", ("report_id",))
    raw = b.raw_reports(spark, sf, reporter=False).select("report_id", "received_date", "drug_name", "source_row", "loaded_at")
    table.write(changes.dedupe_batch(raw.where(F.col("loaded_at") < SPLIT_DAY), ["report_id"], b.last_wins()))
    batch = raw.where(F.col("loaded_at") >= SPLIT_DAY)
    for _ in range(2):
        table.upsert(batch, b.last_wins(), loaded_at=AS_OF)
    return table.read(spark)


@query("table_profile", KEYED + f"""
, merged AS (SELECT * FROM old WHERE report_id NOT IN (SELECT report_id FROM new) UNION ALL SELECT * FROM new)
SELECT column_name, count(*) AS total_rows, count(*) FILTER (missing) AS null_rows,
       round(count(*) FILTER (missing) / count(*) * 100, 2)::DOUBLE AS null_pct, {stamp('max(loaded_at)')} AS newest
FROM (SELECT 'received_date' AS column_name, received_date IS NULL AS missing, loaded_at FROM merged
      UNION ALL SELECT 'drug_name', drug_name IS NULL, loaded_at FROM merged
      UNION ALL SELECT 'source_row', source_row IS NULL, loaded_at FROM merged)
GROUP BY column_name
""")
def table_profile(spark, sf):
    """Counts, null rates and the newest load of a stored table, brought up to date after an upsert."""
    root = shared_dir(spark, "profile")
    table = tables.KeyedTable(f"{root}/reports", ("report_id",))
    raw = b.raw_reports(spark, sf, reporter=False).select("report_id", "received_date", "drug_name", "source_row", "loaded_at")
    table.write(changes.dedupe_batch(raw.where(F.col("loaded_at") < SPLIT_DAY), ["report_id"], b.last_wins()))
    columns = ["received_date", "drug_name", "source_row"]
    monitoring.profile(spark, table, columns, f"{root}/profile", "loaded_at")
    table.upsert(raw.where(F.col("loaded_at") >= SPLIT_DAY), b.last_wins(), loaded_at=AS_OF)
    return monitoring.profile(spark, table, columns, f"{root}/profile", "loaded_at")


@query("load_provenance", FLAT + """
, n AS (SELECT count(*) AS n FROM flat WHERE drug_name IS NOT NULL AND reaction IS NOT NULL)
SELECT '1 live' AS load, n AS landed, 'false' AS used_cache, 'live' AS data_source, n AS loaded, 'success' AS status FROM n
UNION ALL SELECT '2 down', n, 'true', 'cached', n, 'success' FROM n
UNION ALL SELECT '3 empty', 0, 'false', NULL, NULL, 'success'
UNION ALL SELECT '4 down', n, 'true', 'cached', n, 'success' FROM n
""")
def load_provenance(spark, sf):
    """Four loads: live, with the source down, of an empty answer (which does not land), and with the source down again."""
    root = shared_dir(spark, "provenance")
    warehouse = Warehouse(f"{root}/warehouse", buckets=8)
    first = lambda column, field: F.get(F.col(column), F.lit(0))[field].isNotNull()
    documents = reports.parse_documents(b.nested_reports(spark, sf)).where(
        first("patient.drug", "medicinalproduct") & first("patient.reaction", "reactionmeddrapt"))

    def down():
        raise paged.SourceUnavailable("no answer")

    moments = (dt.datetime(2024, 3, 1) + dt.timedelta(minutes=i) for i in range(1000))
    rows = []
    for name, source in (("1 live", lambda: documents), ("2 down", down), ("3 empty", lambda: documents.limit(0)), ("4 down", down)):
        found = run_load(spark, warehouse, source, f"{root}/landing", LOAD_DATE, ("d", name.replace(" ", "-")), lambda: next(moments))
        rows.append((name, found.rows, str(found.used_cache).lower()))
    runs = task_runs(warehouse, spark)
    loads = runs.where("task_id = 'load_reports'").select("run_id", F.col("rows_processed").alias("loaded"))
    landed = runs.where("task_id = 'extract_reports'").select("run_id", "status")
    checks = spark.read.parquet(warehouse.path("monitoring", "freshness_checks")).select(
        F.col("batch").cast("string").alias("run_id"), "data_source")
    known = spark.createDataFrame(rows, "load string, landed bigint, used_cache string").withColumn(
        "run_id", F.replace("load", F.lit(" "), F.lit("-")))
    return known.join(landed, "run_id").join(loads, "run_id", "left").join(checks, "run_id", "left").drop("run_id")


@query("scheduled_load", FLAT + """
SELECT upper(drug_name) AS drug_name, lower(reaction) AS reaction, count(*) AS report_count,
       count(*) FILTER (WHERE serious = '1') AS serious_count, count(*) FILTER (WHERE serious_death = '1') AS fatal_count,
       round(avg(patient_age::DOUBLE), 1) AS avg_patient_age,
       max(received_date[:4] || '-' || received_date[5:6] || '-' || received_date[7:]) AS most_recent_report_date
FROM flat WHERE drug_name IS NOT NULL GROUP BY ALL
""")
def scheduled_load(spark, sf):
    """Landing file to raw table to marts, with the rules as gate; reports without a drug are set aside before."""
    root = shared_dir(spark, "load")
    warehouse = Warehouse(f"{root}/warehouse")
    flat = reports.flatten(reports.parse_documents(b.nested_reports(spark, sf)), LOAD_DATE)
    landing.write_landing(flat, f"{root}/landing", LOAD_DATE, "0001")
    batch = landing.read_batch(spark, f"{root}/landing", LOAD_DATE, "0001")
    clean, _ = quality.quarantine(batch, [quality.not_null("drug_name"), quality.not_null("reaction")])
    load_batch(warehouse, clean, [F.desc("received_date")], AS_OF)
    build_models(warehouse, spark)
    return spark.read.parquet(warehouse.path("mart", "drug_reactions"))


# --- parts of a load on their own -------------------------------------------------------------------------------------

def _landed(spark, sf, name):
    path = shared_dir(spark, name)
    flat = reports.flatten(reports.parse_documents(b.nested_reports(spark, sf)), LOAD_DATE)
    landing.write_landing(flat, path, LOAD_DATE, "0001")
    return path


@query("landing_header", FLAT + f"""
, named AS (SELECT unnest({LANDING_COLUMNS!r}) AS name, (SELECT count(*) FROM flat) AS n)
SELECT name, n AS rows_landed FROM named WHERE name <> 'load_date'
""")
def landing_header(spark, sf):
    """Column names of a landing file from its first line, and the batch as the log of batches has it."""
    path = _landed(spark, sf, "header")
    names = landing.header(spark, landing.batch_path(path, LOAD_DATE, "0001"))
    return landing.batches(spark, path).select(F.explode(F.array(*map(F.lit, names))).alias("name"), F.col("rows").alias("rows_landed"))


@query("missing_batch", FLAT + """
SELECT count(*) > 0 AND false AS found_other_batch, count(*) AS rows_of_newest, 'true' AS names_what_is_there FROM flat
""".replace("count(*) > 0 AND false", "(count(*) < 0)::VARCHAR"))
def missing_batch(spark, sf):
    """Reading a batch that is not there tells what is; the newest batch is still found."""
    path = _landed(spark, sf, "missing")
    try:
        landing.read_batch(spark, path, LOAD_DATE, "0002")
        found, told = "true", "false"
    except FileNotFoundError as problem:
        found, told = "false", str("batch_id=0001" in str(problem)).lower()
    batch = landing.read_batch(spark, path, *landing.latest_batch(spark, path))
    return batch.agg(F.count(F.lit(1)).alias("rows_of_newest")).select(
        F.lit(found).alias("found_other_batch"), "rows_of_newest", F.lit(told).alias("names_what_is_there"))


@query("staging_view", FLAT + """
SELECT count(*) AS view_rows, count(DISTINCT report_id) AS view_reports, count(DISTINCT upper(drug_name)) AS view_drugs
FROM flat WHERE drug_name IS NOT NULL
""")
def staging_view(spark, sf):
    """The staging view that a build leaves behind, read by name."""
    root = shared_dir(spark, "view")
    warehouse = Warehouse(f"{root}/warehouse", buckets=8)
    flat = reports.flatten(reports.parse_documents(b.nested_reports(spark, sf)), LOAD_DATE)
    load_batch(warehouse, flat.where("drug_name is not null and reaction is not null"), [F.desc("received_date")], AS_OF)
    build_models(warehouse, spark)
    return spark.sql("SELECT count(*) AS view_rows, count(DISTINCT report_id) AS view_reports, "
                     "count(DISTINCT drug_name) AS view_drugs FROM stg_case_reports")


@query("quality_gate", FLAT + """
SELECT 'reports.drug_name: not_null failed for ' || count(*) AS message FROM flat WHERE drug_name IS NULL HAVING count(*) > 0
UNION ALL SELECT 'passed' FROM flat HAVING count(*) FILTER (WHERE drug_name IS NULL) = 0
""")
def quality_gate(spark, sf):
    """What the gate says about reports without a drug."""
    flat = reports.flatten(reports.parse_documents(b.nested_reports(spark, sf)), LOAD_DATE)
    try:
        quality.gate(quality.run_rules(flat, [quality.not_null("drug_name"), quality.not_null("report_id")], "reports"))
        message = "passed"
    except quality.DataQualityError as problem:
        message = str(problem)
    return spark.createDataFrame([(message,)], "message string")


@query("added_columns", "SELECT o_orderkey, o_orderstatus, NULL::VARCHAR AS note, NULL::BIGINT AS visits FROM orders")
def added_columns(spark, sf):
    orders = b.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return changes.add_missing_columns(orders, {"o_orderstatus": "int", "note": "string", "visits": "bigint"})


# --- streams ---------------------------------------------------------------------------------------------------------

@query("stream_ingest", FLAT + f"""
SELECT report_id, received_date, CASE WHEN o_orderdate >= DATE '{SPLIT_DAY}' THEN serious ELSE '9' END AS serious, drug_name, reaction,
       round(patient_age::DOUBLE, 2) AS patient_age, country FROM flat
""")
def stream_ingest(spark, sf):
    """Documents arrive in two drops, the second with corrections; a stream upserts each drop and resumes in between."""
    root = shared_dir(spark, "ingest")
    warehouse = Warehouse(f"{root}/warehouse")
    nested = b.nested_reports(spark, sf)
    wrong = F.regexp_replace("json", '"serious":"[12]"', '"serious":"9"')
    recent = F.get_json_object("json", "$.receiptdate") >= SPLIT_DAY.replace("-", "")
    for drop in (nested.select(wrong.alias("value")), nested.where(recent).select(F.col("json").alias("value"))):
        with short_lived_shuffles(spark):
            drop.write.mode("append").option("compression", "gzip").text(f"{root}/documents")
        documents = ingest.document_stream(spark, f"{root}/documents")
        ingest.start_ingest(documents, warehouse, LOAD_DATE, AS_OF, f"{root}/checkpoint").awaitTermination()
    return warehouse.raw.read(spark).select("report_id", "received_date", "serious", "drug_name", "reaction",
                                            "patient_age", "country")


@query("stream_load_counts", f"""
, w AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS s, event_type, count(*) AS n_rows, count(*) FILTER (WHERE value > 100) AS n_failed
        FROM events GROUP BY ALL)
SELECT {stamp('s')} AS window_start, {stamp('s + INTERVAL 1 HOUR')} AS window_end, event_type, n_rows, n_failed
FROM w WHERE s + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 10 MINUTES FROM events)
""")
def stream_load_counts(spark, sf):
    """Hourly counts of the windows that the watermark closed."""
    events = jobs.read_table_stream(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return jobs.drain(load_counts(events, "ts", ["event_type"], F.col("value") > 100), "counts")


@query("stream_triage", f"""
, m AS (SELECT event_id, regexp_replace(CASE WHEN contains(raw_log, 'Traceback (most recent call last):')
               THEN list_filter(string_split(raw_log, chr(10)), lambda line: trim(line) <> '')[-1] ELSE raw_log END,
               '^\\s+|\\s+$', '', 'g') AS error_message
        FROM (SELECT incident_id AS event_id, raw_log FROM x_backfilled)),
h AS (SELECT *, {hint('error_message')} AS error_type FROM m)
SELECT event_id, error_message, error_type, {severity('error_type')} AS severity FROM h
""")
def stream_triage(spark, sf):
    """Alerts parsed and classified as they arrive; missing texts come from the run log, a static table."""
    from caselight.operators.incidents import backfill_logs, classify, parse_logs

    events = jobs.read_table_stream(spark, sf, "events")
    alerts = b.alerts_from(events)
    triaged = classify(parse_logs(backfill_logs(alerts, b.task_runs(spark, sf))))
    return jobs.drain(triaged.select(F.col("incident_id").alias("event_id"), "error_message", "error_type", "severity"), "triage")


@query("stream_audit", f"""
SELECT event_id, tier, reason, statement_type FROM events JOIN x_audited ON n = event_id % {len(STATEMENTS)}
""")
def stream_audit(spark, sf):
    events = jobs.read_table_stream(spark, sf, "events").select("event_id", b._statement("event_id").alias("sql"))
    return jobs.drain(audit(events).select("event_id", "audit.tier", "audit.reason", "audit.statement_type"), "audit")


@query("stream_checks", f"""
SELECT 'not_null' AS rule, 'value' AS column_name, count(*) FILTER (WHERE value < 10) AS failures FROM events
UNION ALL SELECT 'unique', 'event_id', 0
UNION ALL SELECT 'row_count_deviation', 'critical', count(*) FROM events
HAVING abs(count(*) - count(*) FILTER (WHERE event_id % 4 = 0)) / count(*) FILTER (WHERE event_id % 4 = 0)::DOUBLE > 0.5
""")
def stream_checks(spark, sf):
    """Rules and the row-count check on each micro-batch of a stream."""
    root = shared_dir(spark, "checks")
    events = jobs.read_table_stream(spark, sf, "events").withColumn("value", F.when(F.col("value") >= 10, F.col("value")))
    earlier = b.table(spark, sf, "events").where(F.col("event_id") % 4 == 0)
    base = monitors.batch_baseline("raw", "events", earlier, "2024-01-01")
    rules = [quality.not_null("value"), quality.unique("event_id")]
    checks.start_checks(events, rules, base, "raw", "events", CHECKED_AT, root, f"{root}/checkpoint").awaitTermination()
    failures = spark.read.parquet(f"{root}/rules").select("rule", "column_name", "failures")
    alerts = spark.read.parquet(f"{root}/alerts").select(
        F.col("alert_type").alias("rule"), F.col("severity").alias("column_name"),
        F.get_json_object("details", "$.current_count").cast("bigint").alias("failures"))
    return failures.unionByName(alerts)


@query("stream_repeated_keys", """
SELECT user_id, count(DISTINCT event_id % 3) - 1 AS later_batches FROM events WHERE user_id IS NOT NULL
GROUP BY user_id HAVING count(DISTINCT event_id % 3) > 1
""")
def stream_repeated_keys(spark, sf):
    """Events arrive in three batches; users that come again in a later one are reported there."""
    root = shared_dir(spark, "repeated")
    events = b.table(spark, sf, "events")
    for part in range(3):
        events.where(F.col("event_id") % 3 == part).coalesce(1).write.mode("append").parquet(f"{root}/events")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/events")
    base = monitors.batch_baseline("raw", "events", events, "2024-01-01")
    seen = tables.KeyedTable(f"{root}/seen", ("user_id",), buckets=4)
    checks.start_checks(stream, [quality.not_null("user_id")], base, "raw", "events", CHECKED_AT, root, f"{root}/checkpoint",
                        seen=seen).awaitTermination()
    found = spark.read.parquet(f"{root}/repeated").where("first_batch < batch_id")
    return found.groupBy("user_id").agg(F.count(F.lit(1)).alias("later_batches"))


TIMEOUT_STEP = """CASE WHEN coalesce(proposed_sql, '') = '' THEN 'retry' WHEN tier = 'rejected' THEN 'refuse'
    WHEN tier = 'auto_executable' THEN 'apply_rename_and_retry' ELSE 'run_statement_and_retry' END"""


def _fired(requests: str) -> str:
    """SQL for the actions that fall due on open requests until the newest one."""
    due = f"+ INTERVAL 30 MINUTES <= TIMESTAMP {q(AS_OF)}"
    return f"""
SELECT incident_id, severity, 'auto_apply' AS action, {stamp('created_at + INTERVAL 30 MINUTES')} AS due_at, {TIMEOUT_STEP} AS step
FROM {requests} LEFT JOIN x_audited ON sql = proposed_sql WHERE severity = 'P1' AND created_at {due}
UNION ALL
SELECT incident_id, severity, 'send_mail', {stamp('created_at + INTERVAL 30 MINUTES')}, NULL FROM {requests}
WHERE severity = 'P0' AND escalation_email_sent_at IS NULL AND created_at {due}
UNION ALL
SELECT incident_id, severity, 'pause_dag', {stamp('created_at + INTERVAL 60 MINUTES')}, NULL FROM {requests}
WHERE severity = 'P0' AND dag_paused_at IS NULL AND created_at + INTERVAL 30 MINUTES {due}
"""


def _climbed(spark, rows, name):
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, jobs.STATE_PROVIDER)
    try:
        return jobs.drain(ladder.escalations(rows), name)
    finally:
        spark.conf.set(provider, before)


@query("stream_escalations", f"""
, waiting AS (SELECT * FROM x_approvals WHERE status = 'pending')
{_fired('waiting')}
""")
def stream_escalations(spark, sf):
    """The escalation ladder with timers on a stream of approvals; the newest request moves the clock."""
    return _climbed(spark, b.approvals_from(jobs.read_table_stream(spark, sf, "orders")), "ladder")


@query("stream_escalation_order", f"""
, waiting AS (SELECT * FROM x_approvals WHERE incident_id::BIGINT % 3 <> 0 OR incident_id::BIGINT % 2 <> 0)
{_fired('waiting')}
""")
def stream_escalation_order(spark, sf):
    """Several rows per incident, out of order: a rejection handed over before its request, an older one, a repeated request."""
    one = b.approvals_from(jobs.read_table_stream(spark, sf, "orders"))
    key = F.col("incident_id").cast("bigint")
    shift = F.when(key % 2 == 0, F.expr("INTERVAL 0 MINUTES")).otherwise(F.expr("INTERVAL -1 MINUTE"))
    rejected = F.struct(F.lit("rejected").alias("status"), (F.col("created_at") + shift).alias("created_at"))
    asked = F.struct(F.lit("pending").alias("status"), F.col("created_at").alias("created_at"))
    turns = F.when(key % 3 == 0, F.array(rejected, asked, asked)).otherwise(F.array(asked, asked))
    rows = one.withColumn("turn", F.explode(turns)).withColumns(
        {"status": F.col("turn.status"), "created_at": F.col("turn.created_at")}).drop("turn")
    return _climbed(spark, rows, "ladder_order")
