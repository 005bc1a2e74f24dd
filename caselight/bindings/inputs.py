"""The reference-shaped inputs, derived from the benchmark tables with deterministic expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from caselight.bindings.texts import AS_OF, DAG_ID, ERROR_TYPE_CYCLE, LOGS, STATEMENTS
from caselight.functions.measures import moment
from caselight.operators.incidents import approved
from caselight.operators.changes import dedupe_batch
from caselight.operators.lineage import drift_changes
from caselight.operators.monitors import latest_snapshot, schema_diff
from caselight.plans.reports import TASKS

TASK_IDS = list(TASKS)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def pick(values: Sequence[str], index: Column) -> Column:
    """Element of a literal list by zero-based position."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + 1)


def int_div(column: str, by: int) -> Column:
    return F.floor(F.col(column) / by)


# --- reports ---------------------------------------------------------------------------------------------------------

def raw_reports(spark: SparkSession, sf: str, reporter: bool = True) -> DataFrame:
    """Raw reports, one per order line, repeated keys included. ``source_row`` breaks ties of ``loaded_at``.

    Without ``reporter`` the patient sex and the country, which need three more joins, are left out.
    """
    lines = table(spark, sf, "lineitem")
    lines = lines.join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    if reporter:
        lines = (
            lines.join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
            .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        )
    returned = F.col("l_returnflag") == "R"
    death = returned & (F.col("l_linestatus") == "F") & (F.col("l_quantity") > 40)
    columns = {
        "report_id": F.concat("l_orderkey", F.lit("-"), "l_linenumber"),
        "received_date": F.date_format("l_shipdate", "yyyyMMdd"),
        "serious": F.when(returned, "1").when(F.col("l_returnflag") == "A", "2"),
        "serious_death": F.when(death, "1"),
        "serious_hosp": F.when(F.col("l_discount") >= 0.08, "1").when(F.col("l_discount") <= 0.01, "").otherwise("2"),
        "serious_life": F.when(F.col("l_tax") >= 0.06, " 1 "),
        "patient_age": F.col("l_quantity").cast("decimal(10,2)"),
        "patient_age_unit": F.lit("801"),
        "patient_sex": F.when(F.col("c_custkey") % 2 == 0, "1").otherwise("2") if reporter else None,
        "drug_name": F.when(F.col("l_partkey") % 50 != 0, F.concat(F.lit(" "), "p_name", F.lit(" "), F.lower("p_type"))),
        "drug_indication": F.col("p_type"),
        "reaction": F.upper("p_brand"),
        "outcome": (F.col("l_linenumber") % 3 + 1).cast("string"),
        "country": F.col("n_name") if reporter else None,
        "loaded_at": F.col("l_shipdate"),
        "load_date": F.col("l_shipdate").cast("date"),
        "source_row": F.col("l_partkey"),
    }
    return lines.select(*[value.alias(name) for name, value in columns.items() if value is not None])


def last_wins() -> list[Column]:
    return [F.desc("loaded_at"), F.desc("source_row")]


def loaded_reports(spark: SparkSession, sf: str, reporter: bool = True) -> DataFrame:
    """The raw table after keyed loading: one row per report."""
    return dedupe_batch(raw_reports(spark, sf, reporter), ["report_id"], last_wins())


def nested_reports(spark: SparkSession, sf: str) -> DataFrame:
    """One nested report document per order, as (report_no, json). Orders without lines have empty lists."""
    position = ["l_linenumber", "l_shipdate", "l_partkey"]
    lines = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    listed = lines.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(
        *position, F.col("p_name").alias("drug"), F.col("p_type").alias("use"), F.col("p_brand").alias("effect"),
    ))).alias("lines"))
    orders = table(spark, sf, "orders").join(listed, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    entries = F.coalesce("lines", F.array().cast(listed.schema["lines"].dataType))
    drug = F.transform(entries, lambda e: F.struct(e["drug"].alias("medicinalproduct"), e["use"].alias("drugindication")))
    reaction = F.transform(entries, lambda e: F.struct(
        e["effect"].alias("reactionmeddrapt"), (e["l_linenumber"] % 3 + 1).cast("string").alias("reactionoutcome")))
    key = F.col("o_orderkey")
    patient = F.when(key % 11 != 0, F.struct(
        F.when(key % 4 != 0, (key % 90).cast("string")).alias("patientonsetage"), F.lit("801").alias("patientonsetageunit"),
        (key % 2 + 1).cast("string").alias("patientsex"), drug.alias("drug"), reaction.alias("reaction"),
    ))
    source = F.when(key % 13 != 0, F.struct(F.col("o_orderpriority").alias("reportercountry")))
    document = F.struct(
        key.cast("string").alias("safetyreportid"), F.date_format("o_orderdate", "yyyyMMdd").alias("receiptdate"),
        F.when(F.col("o_orderstatus") == "F", "1").otherwise("2").alias("serious"),
        F.when(F.col("o_orderstatus") == "P", "1").alias("seriousnessdeath"),
        patient.alias("patient"), source.alias("primarysource"),
    )
    return orders.select(key.alias("report_no"), F.year("o_orderdate").alias("year"), F.to_json(document).alias("json"))


def numbered(df: DataFrame, group: str, key: str, block: int = 1000) -> DataFrame:
    """Number the rows of each group from 0 in the order of a whole-number key.

    Blocks of keys are numbered on their own and shifted by the sizes of the blocks before them, so no task ever sorts
    more than a block of rows, however large a group is.
    """
    blocked = df.withColumn("__block", F.floor(F.col(key) / block))
    sizes = blocked.groupBy(group, "__block").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(group).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(group, "__block", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    inside = F.row_number().over(Window.partitionBy(group, "__block").orderBy(key)) - 1
    numbers = blocked.withColumn("__inside", inside).join(offsets, [group, "__block"])
    return numbers.withColumn("number", F.col("__offset") + F.col("__inside")).drop("__block", "__inside", "__offset")


def save_pages(spark: SparkSession, sf: str, path: str) -> None:
    """Page envelopes of a hundred documents per calendar year, saved the way the folder fetcher reads them."""
    nested = numbered(nested_reports(spark, sf), "year", "report_no").withColumn("page", F.floor(F.col("number") / 100))
    pages = nested.groupBy("year", "page").agg(F.collect_list(F.struct("number", "json")).alias("documents"))
    totals = nested.groupBy("year").agg(F.count(F.lit(1)).alias("total"))
    envelope = F.concat(
        F.lit('{"meta":{"results":{"total":'), F.col("total").cast("string"), F.lit('}},"results":['),
        F.array_join(F.transform(F.array_sort("documents"), lambda d: d["json"]), ","), F.lit("]}"),
    )
    window = F.concat(F.col("year").cast("string"), F.lit("0101"), F.col("year").cast("string"), F.lit("1231"))
    rows = pages.join(totals, "year").select(window.alias("window"), (F.col("page") * 100).alias("skip"), envelope.alias("value"))
    rows.write.partitionBy("window", "skip").text(path)


# --- runs and incidents ----------------------------------------------------------------------------------------------

def _run_columns() -> list[Column]:
    return [
        F.lit(DAG_ID).alias("dag_id"),
        F.concat(F.lit("run-"), int_div("event_id", 5).cast("string")).alias("run_id"),
        pick(TASK_IDS, F.col("event_id") % 5).alias("task_id"),
    ]


def _log() -> Column:
    return pick(LOGS, F.col("user_id") % len(LOGS))


def _statement(key: str) -> Column:
    return pick(STATEMENTS, F.col(key) % len(STATEMENTS))


def task_runs(spark: SparkSession, sf: str) -> DataFrame:
    """One task run per event."""
    event = F.col("event_id")
    status = F.when(F.col("event_type") == "error", "failed").when(event % 50 == 7, "running").otherwise("success")
    runs = table(spark, sf, "events").withColumn("status", status)
    ended = F.col("ts") + F.make_dt_interval(secs=F.floor("value"))
    return runs.select(
        *_run_columns(), "status", (event % 1000).alias("rows_processed"),
        F.when((F.col("status") == "failed") & (event % 27 != 0), _log()).alias("error_message"),
        F.col("ts").alias("started_at"), F.when(F.col("status") != "running", ended).alias("finished_at"),
    )


def incident_reports(spark: SparkSession, sf: str) -> DataFrame:
    """One decided or open incident per error event."""
    event = F.col("event_id")
    errors = table(spark, sf, "events").where(F.col("event_type") == "error")
    result = pick(["auto_approved", "auto_approved", "approved", "rejected", "escalated", "pending", "pending"], event % 7)
    attempted = pick(["", "Retried the task.", "Renamed a column back to its declared name and retried the failed task.",
                      "No SQL fix makes sense here; a person has to look at the data"], event % 4)
    return errors.select(
        "event_id", *_run_columns(), pick(ERROR_TYPE_CYCLE, F.col("user_id") % 6).alias("error_type"),
        _log().alias("error_message"), F.nullif(attempted, F.lit("")).alias("fix_attempted"),
        result.alias("fix_result"), approved(result).alias("approved"),
        F.when(event % 3 != 0, _statement("event_id")).alias("fix_sql"), F.col("ts").alias("created_at"),
    )


def alerts(spark: SparkSession, sf: str) -> DataFrame:
    """One alert per error event, some of them without a log text."""
    return alerts_from(table(spark, sf, "events"))


def alerts_from(events: DataFrame) -> DataFrame:
    event = F.col("event_id")
    errors = events.where(F.col("event_type") == "error")
    text = F.when(event % 9 == 0, None).when(event % 9 == 1, "").otherwise(_log())
    return errors.select(
        event.alias("incident_id"), *_run_columns(), text.alias("log_text"),
        F.when(event % 4 == 0, pick(ERROR_TYPE_CYCLE, F.col("user_id") % 6)).alias("label"),
        F.lit("raw").alias("schema_name"), tracked_table(F.col("user_id") % 5).alias("table_name"),
        F.col("ts").alias("created_at"),
    )


# --- monitored tables ------------------------------------------------------------------------------------------------

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
CUTOFFS = {"click": "2024-01-29", "error": "2024-01-22"}
CUTOFF = "2024-01-16"


def tracked_table(kind: Column) -> Column:
    """Name of one of twenty monitored tables from a type number and the event number."""
    return F.concat_ws("_", pick(EVENT_TYPES, kind), (F.col("event_id") % 4).cast("string"))


def tracked_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events as rows of twenty monitored tables."""
    name = F.concat_ws("_", "event_type", (F.col("event_id") % 4).cast("string"))
    return table(spark, sf, "events").withColumns({"schema_name": F.lit("raw"), "table_name": name})


def tracked_stats(spark: SparkSession, sf: str) -> DataFrame:
    return tracked_events(spark, sf).groupBy("schema_name", "table_name").agg(
        F.count(F.lit(1)).alias("current_count"), F.max("ts").alias("last_loaded")
    )


def _cutoff() -> Column:
    day = F.lit(CUTOFF)
    for kind, value in CUTOFFS.items():
        day = F.when(F.col("event_type") == kind, value).otherwise(day)
    return day.cast("timestamp_ntz")


def baselines(spark: SparkSession, sf: str) -> DataFrame:
    """An old and a new table baseline and a later batch baseline; none for error_3 and a zero one for purchase_0."""
    counts = tracked_events(spark, sf).where(F.col("table_name") != "error_3").groupBy("schema_name", "table_name").agg(
        F.count_if(F.col("ts") < moment("2024-01-10")).alias("old"),
        F.count_if((F.col("ts") < _cutoff()) & (F.col("table_name") != "purchase_0")).alias("new"),
        F.count_if(F.col("ts") >= moment("2024-01-30")).alias("batch"),
    )
    rows = F.inline(F.array(*[
        F.struct(F.lit(scope).alias("scope"), F.col(name).alias("baseline_count"), moment(at).alias("recorded_at"))
        for scope, name, at in [("table", "old", "2024-01-10"), ("table", "new", "2024-02-01"),
                                ("batch", "batch", "2024-02-02")]
    ]))
    return counts.select("schema_name", "table_name", rows)


def freshness_checks(spark: SparkSession, sf: str) -> DataFrame:
    event = F.col("event_id")
    source = F.when(F.col("user_id") % 3 != 0, F.when(event % 11 == 0, "cached").otherwise("live"))
    return tracked_events(spark, sf).select(
        "schema_name", "table_name", (F.col("ts") - F.make_dt_interval(mins=F.floor("value"))).alias("last_loaded"),
        F.col("ts").alias("checked_at"), (F.col("value") > 100).alias("is_stale"), source.alias("data_source"),
    )


def declared_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Declared columns of the monitored tables: c0 to c11, as far as the events mention them."""
    number = F.floor(F.col("event_id") / 4) % 12
    return tracked_events(spark, sf).select(
        "schema_name", "table_name", F.concat(F.lit("c"), number.cast("string")).alias("column_name"),
        pick(["text", "bigint", "numeric"], number % 3).alias("data_type"),
        F.when(number % 4 == 0, "NO").otherwise("YES").alias("is_nullable"),
    ).distinct()


def snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """Two snapshots of each table except the view ones; the older lacks column c1."""
    declared = declared_columns(spark, sf).where(~F.col("table_name").startswith("view"))
    old = declared.where(F.col("column_name") != "c1").withColumn("snapshotted_at", moment("2024-01-05"))
    return old.unionByName(declared.withColumn("snapshotted_at", moment("2024-02-05")))


def live_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Columns as they are now: _1 renamed one, _2 changed two, _3 added two and lost one, _0 is as declared."""
    table_no, column = F.substring_index("table_name", "_", -1), F.col("column_name")
    declared = declared_columns(spark, sf)
    renamed = F.when((table_no == "1") & (column == "c3"), "c3_new").otherwise(column)
    retyped = F.when((table_no == "2") & (column == "c5"), "date").otherwise(F.col("data_type"))
    nullable = F.when((table_no == "2") & (column == "c8"), "YES").otherwise(F.col("is_nullable"))
    kept = declared.where(~((table_no == "3") & (column == "c4")))
    extra = declared.where((table_no == "3") & column.isin("c6", "c7")).withColumn(
        "column_name", F.concat("column_name", F.lit("_extra")))
    return kept.withColumns({"column_name": renamed, "data_type": retyped, "is_nullable": nullable}).unionByName(extra)


# --- approvals -------------------------------------------------------------------------------------------------------

def approvals(spark: SparkSession, sf: str) -> DataFrame:
    """One approval per order."""
    return approvals_from(table(spark, sf, "orders"))


def approvals_from(orders: DataFrame) -> DataFrame:
    key = F.col("o_orderkey")
    created = moment(AS_OF) - F.make_dt_interval(mins=(key % 90).cast("int"))
    done = F.col("o_orderstatus") == "F"
    return orders.select(
        key.cast("string").alias("incident_id"), F.lit(DAG_ID).alias("dag_id"),
        F.concat(F.lit("run-"), F.col("o_custkey").cast("string")).alias("run_id"),
        pick(TASK_IDS, key % 5).alias("task_id"), F.concat(F.lit("order "), key.cast("string")).alias("summary"),
        pick(["low", "medium", "high"], key % 3).alias("risk_level"),
        F.concat(F.lit("P"), (F.col("o_custkey") % 4).cast("string")).alias("severity"),
        F.when(key % 17 != 0, _statement("o_orderkey")).alias("proposed_sql"),
        F.when(done, "approved").otherwise("pending").alias("status"), created.alias("created_at"),
        F.when(done, moment(AS_OF)).alias("resolved_at"), F.when(done, "ana").alias("resolved_by"),
        F.when(key % 5 == 0, moment(AS_OF)).alias("escalation_email_sent_at"),
        F.when(key % 7 == 0, moment(AS_OF)).alias("dag_paused_at"),
    )


def requests(spark: SparkSession, sf: str) -> DataFrame:
    """Approval requests from error events, some repeated, about a third of them for new incidents."""
    errors = table(spark, sf, "events").where(F.col("event_type") == "error")
    number = int_div("event_id", 4).cast("string")
    return errors.select(
        F.when(F.floor(F.col("event_id") / 4) % 3 == 0, F.concat(F.lit("n"), number)).otherwise(number).alias("incident_id"),
        *_run_columns(), F.concat(F.lit("event "), F.col("event_id").cast("string")).alias("summary"),
        pick(["low", "medium", "high"], F.col("user_id") % 3).alias("risk_level"),
        F.concat(F.lit("P"), (F.col("user_id") % 3).cast("string")).alias("severity"),
        _statement("user_id").alias("proposed_sql"), F.col("ts").alias("requested_at"),
    )


def decisions(spark: SparkSession, sf: str) -> DataFrame:
    """Clicks on approve or reject, some incidents decided more than once, some unknown."""
    clicks = table(spark, sf, "events").where(F.col("event_type") == "purchase")
    return clicks.select(
        (int_div("event_id", 3) * 5).cast("string").alias("incident_id"),
        F.when(F.col("user_id") % 2 == 0, "approve").otherwise("reject").alias("action"),
        F.when(F.col("user_id") % 10 != 0, F.concat(F.lit("user"), F.col("user_id").cast("string"))).alias("username"),
        F.col("ts").alias("decided_at"),
    )


# --- lineage and memory ----------------------------------------------------------------------------------------------

def lineage_edges(spark: SparkSession, sf: str) -> DataFrame:
    """A binary tree over the event numbers with some edges back up, so it has cycles."""
    events = table(spark, sf, "events").select(F.col("event_id").alias("n"), "event_type")
    parent = F.floor((F.col("n") - 1) / 2)
    down = events.where("n > 0").select(parent.alias("parent"), F.col("n").alias("child"))
    back = events.where("n > 0 and event_type = 'error'").select(F.col("n").alias("parent"), parent.alias("child"))
    return down.unionByName(back)


def lineage_nodes(spark: SparkSession, sf: str) -> DataFrame:
    event = F.col("event_id")
    column = (int_div("event_id", 4) % 12).cast("string")
    code = F.concat(F.lit("select "), F.col("event_type"), F.lit("_ID, C"), column, F.lit(" from src"))
    return table(spark, sf, "events").select(
        event.alias("unique_id"), F.when(event % 3 != 0, "model").otherwise("test").alias("resource_type"),
        F.concat(F.lit("model_"), event.cast("string")).alias("name"),
        F.when(event % 2 == 0, code).otherwise("").alias("raw_code"),
        F.when(event % 5 != 0, F.upper(code)).alias("compiled_code"),
    )


def lineage_sources(spark: SparkSession, sf: str) -> DataFrame:
    """The monitored tables as sources: each stands above the last event it got. Tables of clicks are not in the graph."""
    last = tracked_events(spark, sf).where("event_type <> 'click' AND event_id > 0").groupBy(
        F.col("schema_name").alias("source_name"), F.col("table_name").alias("name")).agg(F.max("event_id").alias("n"))
    return last.select("source_name", "name", F.floor((F.col("n") - 1) / 2).alias("unique_id"))


def drift(spark: SparkSession, sf: str) -> DataFrame:
    """The changed columns of the monitored tables that are sources of the lineage graph."""
    diffs = schema_diff(live_columns(spark, sf), latest_snapshot(snapshots(spark, sf)))
    return drift_changes(diffs, lineage_sources(spark, sf))


def incident_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Incident memory: one vector per past incident, numbered in the order of the incidents."""
    key = F.col("vec_id")
    return table(spark, sf, "embeddings").select(
        key.alias("incident_id"), key.alias("query_id"), F.col("embedding").alias("vector"),
        (key % 2 == 1).alias("has_sql_fix"), F.concat(F.lit("incident "), key.cast("string")).alias("summary"),
        F.concat(F.lit("Fixed like "), key.cast("string")).alias("description"),
        F.when(key % 3 != 0, pick(["low", "medium", "high"], key % 3)).alias("risk_level"),
        _statement("vec_id").alias("sql"),
    )
