"""One scheduled load: landing files to raw table, staging view, marts and monitoring rows."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from caselight.functions.measures import moment
from caselight.operators import drills, monitors, quality, runlog
from caselight.plans import marts
from caselight.plans.staging import normalize_codes, stage_reports
from caselight.schemas import LANDING_COLUMNS, RAW_COLUMNS, RAW_TYPES, REQUIRED_COLUMNS, SNAPSHOT_DDL, TASK_RUN_DDL
from caselight.session import remove, short_lived_shuffles
from caselight.sources import landing, tables
from caselight.sources.paged import Fetcher, SourceUnavailable, position, register
from caselight.sources.reports import explode_pages, flatten

logger = logging.getLogger(__name__)

TABLE = ("raw", "case_reports")
CURSOR_DDL = "date_range string, skip bigint, moved_at timestamp_ntz"


@dataclass(frozen=True)
class Warehouse:
    """Paths of the tables below one root folder, and into how many buckets the raw table is cut."""

    root: str
    buckets: int = 32

    @property
    def raw(self) -> tables.KeyedTable:
        return tables.KeyedTable(f"{self.root}/raw/case_reports", ("report_id",), self.buckets)

    def path(self, schema: str, table: str) -> str:
        return f"{self.root}/{schema}/{table}"


@dataclass(frozen=True)
class Extracted:
    """One landing batch: where it is, its rows, and whether it is an old one because the source was down."""

    load_date: str
    batch_id: str
    rows: int
    used_cache: bool


def extract(
    spark: SparkSession, documents: Callable[[], DataFrame], landing_path: str, load_date: str, batch_id: str
) -> Extracted:
    """Land the documents of a source; if it cannot be reached, fall back to the newest batch that landed before.

    Only ``SourceUnavailable`` means that the source cannot be reached. Whatever else goes wrong, a missing column, a
    full disk, a batch that cannot be read back, fails the load.
    """
    try:
        rows = landing.write_landing(flatten(documents(), load_date), landing_path, load_date, batch_id)
        return Extracted(load_date, batch_id, rows, used_cache=False)
    except (SourceUnavailable, PySparkException) as problem:
        if not is_unavailable(problem):
            raise
        logger.warning("the source cannot be reached, using the newest landing batch: %s", problem)
    old_date, old_batch = landing.latest_batch(spark, landing_path)
    return Extracted(old_date, old_batch, landing.read_batch(spark, landing_path, old_date, old_batch).count(), True)


def is_unavailable(problem: Exception) -> bool:
    """Whether the fetch side raised ``SourceUnavailable``, here or in a task, whose error Spark passes on as text."""
    name = f"{SourceUnavailable.__name__}:"
    return isinstance(problem, SourceUnavailable) or any(
        line.split(" ", 1)[0].endswith(name) for line in str(problem).splitlines())


def logged(
    warehouse: Warehouse, spark: SparkSession, run: tuple[str, str], task_id: str, work: Callable[[], int | None],
    clock: Callable[[], dt.datetime],
) -> int | None:
    """Run one task of a load and append its start and its finish, with rows or error, to the run log."""
    log = warehouse.path("monitoring", "pipeline_runs")
    key = spark.createDataFrame([(*run, task_id)], "dag_id string, run_id string, task_id string")

    started = clock()

    def finish(status: str, rows: int | None = None, error: str | None = None) -> None:
        result = key.select(
            "*", F.lit(status).alias("status"), F.lit(rows).cast("bigint").alias("rows_processed"),
            F.lit(error).cast("string").alias("error_message"))
        tables.append(runlog.finish_events(result, started, clock()), log)

    tables.append(runlog.start_events(key, started), log)
    try:
        rows = work()
    except Exception as problem:
        finish("failed", error=str(problem))
        raise
    finish("success", rows)
    return rows


def task_runs(warehouse: Warehouse, spark: SparkSession) -> DataFrame:
    """Every attempt of every task in the log."""
    return runlog.fold(tables.read_log(spark, warehouse.path("monitoring", "pipeline_runs"), TASK_RUN_DDL))


def run_load(
    spark: SparkSession, warehouse: Warehouse, documents: Callable[[], DataFrame], landing_path: str, load_date: str,
    run: tuple[str, str], clock: Callable[[], dt.datetime], clean_codes: bool = False, exclude: tuple[str, ...] = (),
    drill: str = "none", seed: int = 0,
) -> Extracted:
    """One load from end to end: extract, validate, load, build. Each task is logged; the first failure stops the load.

    ``run`` is (dag_id, run_id) and also names the landing batch. When nothing came in, the later tasks do not run. With a
    ``drill`` the load first damages the raw table as it is, see ``drill_raw``.
    """
    found: list[Extracted] = []
    if drill != "none":
        logged(warehouse, spark, run, "run_drill", lambda: drill_raw(warehouse, spark, drill, clock(), seed), clock)

    def extract_reports() -> int:
        found.append(extract(spark, documents, landing_path, load_date, run[1]))
        return found[0].rows

    def batch() -> DataFrame:
        return landing.read_batch(spark, landing_path, found[0].load_date, found[0].batch_id)

    def validate_schema() -> None:
        names = landing.header(spark, landing.batch_path(landing_path, found[0].load_date, found[0].batch_id))
        quality.require_names(names, REQUIRED_COLUMNS)
        if warehouse.raw.exists(spark):
            record_schema(warehouse, warehouse.raw.read(spark), clock(), run[1])

    def load_reports() -> int:
        order = [F.desc_nulls_last("received_date"), F.desc_nulls_last("outcome")]
        return load_batch(warehouse, batch(), order, clock(), found[0].used_cache, clean_codes, run[1])

    def build() -> None:
        build_models(warehouse, spark, exclude)

    logged(warehouse, spark, run, "extract_reports", extract_reports, clock)
    if found[0].rows > 0:
        logged(warehouse, spark, run, "validate_schema", validate_schema, clock)
        logged(warehouse, spark, run, "load_reports", load_reports, clock)
        logged(warehouse, spark, run, "build_models", build, clock)
    return found[0]


def drill_raw(warehouse: Warehouse, spark: SparkSession, drill: str, at, seed: int = 0) -> int | None:
    """Damage the stored raw table on purpose; returns how many rows it has then, None if there was nothing to damage.

    The table as it was before the first drill is kept as a copy (``restore_raw`` brings it back). The damaged rows go to a
    new folder and are published as one version, so a drill that dies half way has done nothing.
    """
    damage = {
        "volume_anomaly": lambda df: drills.drop_rows(df, ["report_id"], seed),
        "data_quality": lambda df: drills.null_values(df, "drug_name", ["report_id"], seed),
        "schema_drift": drills.rename,
        "freshness_failure": lambda df: drills.make_stale(df, at),
    }.get(drill)
    if damage is None:
        logger.warning("unknown drill %r, nothing done", drill)
        return None
    if not warehouse.raw.exists(spark):
        return None
    stored = warehouse.raw.read(spark)
    tables.snapshot_once(stored, warehouse.path("backup", "case_reports"))
    warehouse.raw.write(damage(stored))
    return warehouse.raw.read(spark).count()


def restore_raw(warehouse: Warehouse, spark: SparkSession) -> None:
    """Put the copy from before the first drill back and give it up."""
    path = warehouse.path("backup", "case_reports")
    warehouse.raw.write(drills.restore(spark.read.parquet(path)))
    remove(spark, path)


def typed_batch(batch: DataFrame) -> DataFrame:
    """A landing batch, all text, with the types of the raw table."""
    columns = [F.col(name) for name in LANDING_COLUMNS if name not in ("patient_age", "load_date")]
    return batch.select(
        *columns, F.col("patient_age").try_cast("decimal(10,2)").alias("patient_age"),
        F.to_date("load_date").alias("load_date"),
    )


def load_batch(
    warehouse: Warehouse, batch: DataFrame, order: list[Column], at, used_cache: bool = False, clean_codes: bool = False,
    batch_id: str = "0",
) -> int:
    """Upsert one landing batch into the raw table and log its size and freshness; returns the number of rows.

    An empty batch changes nothing and logs nothing. The same batch loaded again replaces its log rows. The typed rows are
    kept as a Parquet folder while the load runs: a fraction of the disk that cached rows spill to.
    """
    spark, folder = batch.sparkSession, f"{warehouse.path('loading', TABLE[1])}/{batch_id}"
    batch = quality.require_columns(landing.lower_names(batch), REQUIRED_COLUMNS)
    typed = typed_batch(normalize_codes(batch) if clean_codes else batch)
    try:
        with short_lived_shuffles(spark):
            typed.write.mode("overwrite").parquet(folder)
            batch = spark.read.schema(typed.schema).parquet(folder)
            rows = batch.count()
            if rows == 0:
                return 0
            warehouse.raw.upsert(batch, order, loaded_at=at)
            tables.put(monitors.batch_baseline(*TABLE, batch, at), warehouse.path("monitoring", "row_count_baselines"), batch_id)
            one = spark.range(1).select(
                *[value.alias(name) for name, value in monitors.load_record(*TABLE, used_cache, at).items()])
            tables.put(one, warehouse.path("monitoring", "freshness_checks"), batch_id)
            return rows
    finally:
        remove(spark, folder)


def report_groups(warehouse: Warehouse, spark: SparkSession) -> DataFrame:
    """``marts.report_groups`` of the raw table, kept from load to load.

    What was grouped before is brought up to date with the buckets that loads replaced since then; the rest of the raw table
    is not read, unless a group may have lost its newest date. Without an earlier result, or when its version of the raw
    table was cleaned away, the whole table is grouped. The result of each version has a folder of its own and counts once the
    log names it, so a build that dies is done again from the one before.
    """
    path, log = warehouse.path("mart_state", "report_groups"), warehouse.path("mart_state", "built")
    version = warehouse.raw.version(spark)
    built = [row["version"] for row in tables.read_log(spark, log, "version bigint").select("version").distinct().collect()]
    last = max((v for v in built if v <= version), default=None)
    if last != version:
        staged = stage_reports(warehouse.raw.read(spark))
        changes = warehouse.raw.changes(spark, last) if last is not None else None
        if changes is None:
            tables.rebuild(marts.report_groups(staged), f"{path}/{version}")
        else:
            removed, added = (None if rows is None else stage_reports(with_raw_columns(rows)) for rows in changes)
            changed = marts.changed_groups(spark.read.parquet(f"{path}/{last}"), removed, added)
            tables.rebuild(changed, f"{path}/{version}-changed")
            changed = spark.read.parquet(f"{path}/{version}-changed")
            lost = not changed.where("lost").isEmpty()
            tables.rebuild(marts.with_newest(changed, staged) if lost else changed.drop("lost"), f"{path}/{version}")
            remove(spark, f"{path}/{version}-changed")
        tables.put(spark.createDataFrame([(version,)], "version bigint"), log, str(version))
        remove(spark, *[f"{path}/{v}" for v in built if v != version], *[f"{log}/{tables.BATCH}={v}" for v in built if v != version])
    return spark.read.parquet(f"{path}/{version}")


def with_raw_columns(rows: DataFrame) -> DataFrame:
    """Rows of some buckets with all columns of the raw table, null where none of those buckets has one."""
    missing = [name for name in RAW_COLUMNS if name not in rows.columns]
    return rows.select("*", *[F.lit(None).cast(RAW_TYPES.get(name, "string")).alias(name) for name in missing])


def build_models(warehouse: Warehouse, spark: SparkSession, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Rebuild both marts, then run the rules of the staging view; returns the rule report and raises if any failed.

    Both marts come from one grouping that is kept up to date from load to load (``report_groups``), so a load does not scan
    the raw table for them. The rules read the columns that they are about.
    """
    staged = stage_reports(warehouse.raw.read(spark))
    staged.createOrReplaceTempView("stg_case_reports")
    groups = report_groups(warehouse, spark)
    tables.rebuild(marts.drug_reactions_from_groups(groups), warehouse.path("mart", "drug_reactions"))
    tables.rebuild(marts.serious_events_from_groups(groups), warehouse.path("mart", "serious_events"),
                   ["drug_name", "severity_rank"])
    rules = quality.run_rules(staged, quality.STAGED_RULES, "stg_case_reports", exclude)
    report = spark.createDataFrame(rules.collect(), rules.schema)  # one row per rule
    quality.gate(report)
    return report


def record_schema(warehouse: Warehouse, df: DataFrame, at, batch_id: str) -> None:
    """Store the live columns of the raw table if they are new or changed, so that a drift check still sees the change
    until then, and drift is not hidden by the loads that follow it."""
    path = warehouse.path("monitoring", "schema_snapshots")
    known = tables.read_log(df.sparkSession, path, SNAPSHOT_DDL)
    live = monitors.schema_rows(df, *TABLE)
    diff = monitors.schema_diff(live, monitors.latest_snapshot(known))
    first = monitors.snapshots_to_record(live, diff.where("not has_prior_snapshot"), at)
    if not first.isEmpty():
        tables.put(first, path, batch_id)


def run_paged_load(
    spark: SparkSession, warehouse: Warehouse, fetch: Fetcher, options: dict[str, str], landing_path: str, load_date: str,
    run: tuple[str, str], clock: Callable[[], dt.datetime], **more,
) -> Extracted:
    """``run_load`` from a paged source, from the stored cursor on.

    ``options`` are those of the source; its ``date_range`` is where the first load starts. After a load that took live
    data the cursor moves on by the rows fetched, in the window they came from. A load from the cache leaves it alone.
    """
    path = warehouse.path("monitoring", "cursors")
    last = tables.read_log(spark, path, CURSOR_DDL).orderBy(F.desc("moved_at")).first()
    start = options | ({"date_range": last["date_range"], "skip": str(last["skip"])} if last else {})
    register(spark, fetch)
    where: dict = {}

    def documents() -> DataFrame:
        where.update(position(start, fetch))
        here = start | {"date_range": where["date_range"], "skip": str(where["skip"])}
        return explode_pages(spark.read.format("paged_reports").options(**here).load())

    done = run_load(spark, warehouse, documents, landing_path, load_date, run, clock, **more)
    if not done.used_cache and done.rows:
        row = spark.createDataFrame([(where["date_range"], where["skip"] + done.rows)], "date_range string, skip bigint")
        tables.put(row.withColumn("moved_at", moment(clock())), path, run[1])
    return done
