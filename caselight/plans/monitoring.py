"""The monitor job: all checks over the live tables, what they find stored in the monitoring tables."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from caselight.operators import monitors
from caselight.plans.ingest import Warehouse
from caselight.schemas import BASELINE_DDL, SNAPSHOT_DDL
from caselight.sources import tables

logger = logging.getLogger(__name__)

PROFILE_DDL = "leaf bigint, load bigint, column_name string, n bigint, nulls bigint, newest timestamp_ntz"

#: Where the rows of each kind are stored.
LOGS = {"alerts": "alerts", "baselines": "row_count_baselines", "freshness": "freshness_checks",
        "snapshots": "schema_snapshots"}


def measured(watched: Mapping[str, DataFrame], schema: str) -> tuple[list[DataFrame], list[str]]:
    """Count and newest load time of each table, one scan per table, and the tables that could not be read."""
    stats, failed = [], []
    for name, df in watched.items():
        try:
            one = monitors.table_stats({name: df}, schema)
            stats.append(df.sparkSession.createDataFrame(one.collect(), one.schema))  # a single row
        except PySparkException:
            logger.exception("table %s cannot be read", name)
            failed.append(name)
    return stats, failed


def run_monitors(
    spark: SparkSession, warehouse: Warehouse, watched: Mapping[str, DataFrame], schema: str, as_of, run_id: str
) -> list[str]:
    """Run every check and store its alerts and rows; returns the names of tables and checks that failed.

    A table seen for the first time gets its baseline and its snapshot; a changed one a new snapshot; every run adds its
    freshness rows. Checks are run and stored one by one, so a failing one takes no other with it. Rows are stored per run:
    the same run repeated replaces its own rows, and does not see them while it runs.
    """
    stats, failed = measured(watched, schema)
    if not stats:
        return failed

    def log(name: str, ddl: str) -> DataFrame:
        found = tables.read_log(spark, warehouse.path("monitoring", LOGS[name]), f"{ddl}, {tables.BATCH} string", keep_batch=True)
        return found.where(~found[tables.BATCH].startswith(f"{run_id}-")).drop(tables.BATCH)

    readable = {name: df for name, df in watched.items() if name not in failed}
    found = monitors.checks(
        reduce(DataFrame.unionByName, stats), monitors.live_schemas(readable, schema), log("baselines", BASELINE_DDL),
        log("snapshots", SNAPSHOT_DDL), as_of)
    for name, check in found.items():
        try:
            # Computed before the folder of an earlier try of this run is replaced: a row per table or column.
            results = {kind: (rows.collect(), rows.schema) for kind, rows in check().items()}
        except PySparkException:
            logger.exception("check %s failed", name)
            failed.append(name)
            continue
        for kind, (rows, schema_of) in results.items():  # what cannot be stored fails the job
            tables.put(spark.createDataFrame(rows, schema_of), warehouse.path("monitoring", LOGS[kind]), f"{run_id}-{name}")
    return failed


def profile(spark: SparkSession, table: tables.KeyedTable, columns: Sequence[str], path: str, newest: str | None = None) -> DataFrame:
    """(column_name, total_rows, null_rows, null_pct, newest) of a keyed table, kept bucket by bucket in a log at ``path``.

    A bucket never changes: a load writes it anew under another name. So only buckets that no earlier profile has seen are
    read, and a second profile of an unchanged table reads none. Counts add up and maxima merge; ``newest`` names a
    timestamp column. A column that a bucket lacks is null in all its rows.
    """
    known = tables.read_log(spark, path, PROFILE_DDL)
    places = table.places(spark)
    if not places:
        raise FileNotFoundError(f"no table at {table.path}")
    now = spark.createDataFrame([(leaf, load) for leaf, (load, rows) in places.items() if rows], "leaf bigint, load bigint")
    wanted = spark.createDataFrame([(name,) for name in columns], "column_name string")
    seen = known.join(wanted, "column_name", "left_semi").join(now, ["leaf", "load"], "left_semi")
    complete = {(row["leaf"], row["load"]) for row in seen.groupBy("leaf", "load").agg(
        F.count_distinct("column_name").alias("n")).where(F.col("n") == len(set(columns))).collect()}
    missing = {leaf: place for leaf, place in places.items() if place[1] and (leaf, place[0]) not in complete}
    if missing:
        rows = table.stored(spark, missing)
        latest = F.max(newest if newest in rows.columns else F.lit(None).cast("timestamp_ntz")) if newest else F.lit(None).cast("timestamp_ntz")
        counted = rows.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), latest.alias("newest"), *[
            (F.count_if(F.col(f"`{name}`").isNull()) if name in rows.columns else F.count(F.lit(1))).alias(f"nulls_{i}")
            for i, name in enumerate(columns)])
        loads = spark.createDataFrame([(leaf, place[0]) for leaf, place in missing.items()], "leaf bigint, load bigint")
        each = F.explode(F.array(*[F.struct(F.lit(name).alias("column_name"), F.col(f"nulls_{i}").alias("nulls"))
                                   for i, name in enumerate(columns)])).alias("c")
        fresh = counted.join(loads, "leaf").select("leaf", "load", "n", "newest", each).select(
            "leaf", "load", "c.column_name", "n", "c.nulls", "newest")
        tables.put(fresh, path, f"version-{table.version(spark)}")
        known = tables.read_log(spark, path, PROFILE_DDL)
    current = known.join(now, ["leaf", "load"], "left_semi").dropDuplicates(["leaf", "load", "column_name"])
    summed = current.groupBy("column_name").agg(
        F.sum("n").alias("total_rows"), F.sum("nulls").alias("null_rows"), F.max("newest").alias("newest"))
    rate = F.when(F.col("total_rows") > 0, F.round(F.col("null_rows") / F.col("total_rows") * 100, 2)).otherwise(0.0)
    return wanted.distinct().join(summed, "column_name", "left").select(
        "column_name", F.coalesce("total_rows", F.lit(0)).alias("total_rows"), F.coalesce("null_rows", F.lit(0)).alias("null_rows"),
        rate.alias("null_pct"), "newest")
