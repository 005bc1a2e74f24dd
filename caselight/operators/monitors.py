"""Row-count, freshness and schema monitors for any number of tables at once."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from caselight.functions.measures import deviation, hours_between, moment
from caselight.operators.latest import latest_per_key

logger = logging.getLogger(__name__)

# Alert thresholds.
COUNT_THRESHOLD = 0.30
COUNT_CRITICAL = 0.50
STALE_HOURS = 24
WARN_HOURS = 25
ERROR_HOURS = 49

# Wording of alerts.
COUNT_MESSAGE = "%s row count deviated %.1f%% from baseline (%d vs %d)"
NEVER_LOADED_MESSAGE = "%s has no rows / no loaded_at timestamp."
STALE_MESSAGE = "%s last loaded %.1fh ago (threshold: %sh)"
DRIFT_MESSAGE = "Schema change detected on %s: added=%s removed=%s changed_types=%s"

TABLE_KEY = ["schema_name", "table_name"]
ALERT_COLUMNS = ["alert_type", "severity", *TABLE_KEY, "message", "details", "timestamp"]


def _qualified() -> Column:
    return F.concat_ws(".", "schema_name", "table_name")


# --- table statistics ------------------------------------------------------------------------------------------------

def table_stats(tables: Mapping[str, DataFrame], schema: str, loaded_at: str = "loaded_at") -> DataFrame:
    """Row count and newest load time of each table, one scan per table; empty tables keep their row."""
    parts = []
    for name, df in tables.items():
        newest = F.max(loaded_at) if loaded_at in df.columns else F.lit(None)
        parts.append(df.agg(F.count(F.lit(1)).alias("current_count"), newest.cast("timestamp_ntz").alias("last_loaded"))
                     .select(F.lit(schema).alias("schema_name"), F.lit(name).alias("table_name"), "*"))
    return reduce(DataFrame.unionByName, parts)


# --- row counts ------------------------------------------------------------------------------------------------------

def latest_baselines(baselines: DataFrame, scope: str | None = "table") -> DataFrame:
    """Newest baseline of each table.

    Baselines recorded after a load hold the size of one batch; comparing those with whole tables is what ``scope``
    avoids. ``scope=None`` takes the newest baseline of either kind.
    """
    chosen = baselines if scope is None else baselines.where(F.col("scope") == scope)
    newest = latest_per_key(chosen, TABLE_KEY, [F.desc_nulls_last("recorded_at")])
    return newest.select(*TABLE_KEY, "baseline_count")


def count_check(
    counts: DataFrame, baselines: DataFrame, threshold: float = COUNT_THRESHOLD, critical: float = COUNT_CRITICAL,
    scope: str | None = "table",
) -> DataFrame:
    """Each table with its baseline, deviation and severity (null while within the threshold or without a baseline)."""
    joined = counts.select(*TABLE_KEY, "current_count").join(latest_baselines(baselines, scope), TABLE_KEY, "left")
    measured = joined.withColumn("deviation", deviation(F.col("current_count"), F.col("baseline_count")))
    level = F.when(F.col("deviation") > critical, "critical").when(F.col("deviation") > threshold, "warning")
    return measured.withColumn("severity", level).withColumn("deviation_pct", F.round(F.col("deviation") * 100, 2))


def count_alerts(checks: DataFrame, at, threshold: float = COUNT_THRESHOLD) -> DataFrame:
    message = F.format_string(
        COUNT_MESSAGE, _qualified(), F.round(F.col("deviation") * 100, 1), F.col("current_count"), F.col("baseline_count"),
    )
    details = F.to_json(F.struct(
        "current_count", "baseline_count", "deviation_pct", F.lit(threshold * 100).alias("threshold_pct")
    ))
    return _alerts(checks.where(F.col("severity").isNotNull()), "row_count_deviation", F.col("severity"), message,
                   details, at)


def first_baselines(checks: DataFrame, at) -> DataFrame:
    """Baseline rows for tables seen for the first time; those raise no alert."""
    return checks.where(F.col("baseline_count").isNull()).select(
        *TABLE_KEY, F.lit("table").alias("scope"), F.col("current_count").alias("baseline_count"),
        moment(at).alias("recorded_at"),
    )


def batch_baseline(schema: str, table: str, batch: DataFrame, at) -> DataFrame:
    """Size of one loaded batch as a baseline row."""
    return batch.agg(F.count(F.lit(1)).alias("baseline_count")).select(
        F.lit(schema).alias("schema_name"), F.lit(table).alias("table_name"), F.lit("batch").alias("scope"),
        "baseline_count", moment(at).alias("recorded_at"),
    )


# --- freshness -------------------------------------------------------------------------------------------------------

def freshness_check(stats: DataFrame, as_of, stale_hours: float = STALE_HOURS) -> DataFrame:
    """Freshness rows for every table: stale when it has no load time or the last one is too old."""
    hours = hours_between(F.col("last_loaded"), moment(as_of))
    return stats.select(
        *TABLE_KEY, "last_loaded", moment(as_of).alias("checked_at"), hours.alias("hours_since_load"),
        F.coalesce(hours > stale_hours, F.lit(True)).alias("is_stale"),
    )


def freshness_alerts(checks: DataFrame, at, stale_hours: float = STALE_HOURS) -> DataFrame:
    message = F.when(
        F.col("last_loaded").isNull(), F.format_string(NEVER_LOADED_MESSAGE, _qualified())
    ).otherwise(F.format_string(
        STALE_MESSAGE, _qualified(), F.round("hours_since_load", 1), F.lit(f"{stale_hours:g}")
    ))
    details = F.to_json(F.struct(
        F.date_format("last_loaded", "yyyy-MM-dd'T'HH:mm:ss").alias("last_loaded"),
        F.round("hours_since_load", 2).alias("hours_since_load"), F.lit(stale_hours).alias("threshold_hours"),
    ), {"ignoreNullFields": "false"})
    return _alerts(checks.where("is_stale"), "freshness_violation", F.lit("critical"), message, details, at)


def freshness_level(checks: DataFrame, warn: float = WARN_HOURS, error: float = ERROR_HOURS) -> DataFrame:
    """Two-step source freshness rule: pass, warn or error."""
    hours = F.col("hours_since_load")
    level = F.when(hours.isNull() | (hours > error), "error").when(hours > warn, "warn").otherwise("pass")
    return checks.withColumn("level", level)


def load_record(schema: str, table: str, used_cache: bool, at) -> dict[str, Column]:
    """Columns of the freshness row that a load writes, with where its data came from."""
    return {
        "schema_name": F.lit(schema), "table_name": F.lit(table), "last_loaded": moment(at), "checked_at": moment(at),
        "is_stale": F.lit(used_cache), "data_source": provenance(F.lit(used_cache)),
    }


def provenance(used_cache: Column) -> Column:
    return F.when(used_cache, "cached").otherwise("live")


# --- schemas ---------------------------------------------------------------------------------------------------------

def schema_rows(df: DataFrame, schema: str, table: str) -> DataFrame:
    """Columns of a live table as rows (column_name, data_type, is_nullable)."""
    rows = [(schema, table, f.name, f.dataType.simpleString(), "YES" if f.nullable else "NO") for f in df.schema.fields]
    ddl = "schema_name string, table_name string, column_name string, data_type string, is_nullable string"
    return df.sparkSession.createDataFrame(rows, ddl)


def latest_snapshot(snapshots: DataFrame) -> DataFrame:
    """Rows of the newest snapshot of each table. The newest time per table is a map-side aggregate, not a window."""
    newest = snapshots.groupBy(*TABLE_KEY).agg(F.max("snapshotted_at").alias("snapshotted_at"))
    return snapshots.join(newest, [*TABLE_KEY, "snapshotted_at"])


def schema_diff(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Added, removed and changed columns of each live table against its snapshot.

    A column changed when its type or its nullability did. Both sides are united and grouped by column, so there is one
    shuffle and no join; the lists are as long as a table is wide. Tables that only have a snapshot are not reported.
    """
    def side(df: DataFrame, is_current: bool) -> DataFrame:
        meta = F.struct("data_type", "is_nullable")
        empty = F.lit(None).cast("struct<data_type: string, is_nullable: string>")
        return df.select(*TABLE_KEY, "column_name", (meta if is_current else empty).alias("now"),
                         (empty if is_current else meta).alias("before"))

    columns = side(current, True).unionByName(side(previous, False)).groupBy(*TABLE_KEY, "column_name").agg(
        F.max("now").alias("now"), F.max("before").alias("before")
    )
    now, before = F.col("now"), F.col("before")

    def names(condition: Column) -> Column:
        return F.array_sort(F.collect_list(F.when(condition, F.col("column_name"))))

    return columns.groupBy(*TABLE_KEY).agg(
        F.bool_or(before.isNotNull()).alias("has_prior_snapshot"),
        F.bool_or(now.isNotNull()).alias("is_live"),
        names(now.isNotNull() & before.isNull()).alias("added"),
        names(now.isNull() & before.isNotNull()).alias("removed"),
        names(now.isNotNull() & before.isNotNull() & (now != before)).alias("changed_types"),
    ).where("is_live").drop("is_live").select(
        *TABLE_KEY, "has_prior_snapshot",
        *[F.when(F.col("has_prior_snapshot"), F.col(c)).otherwise(F.array().cast("array<string>")).alias(c)
          for c in ("added", "removed", "changed_types")],
    ).withColumn("has_drift", F.size("added") + F.size("removed") + F.size("changed_types") > 0)


def listed(names: Column) -> Column:
    """An array of names as ``['a', 'b']``."""
    return F.concat(F.lit("["), F.array_join(F.transform(names, lambda n: F.concat(F.lit("'"), n, F.lit("'"))), ", "),
                    F.lit("]"))


def schema_alerts(diff: DataFrame, at) -> DataFrame:
    message = F.format_string(DRIFT_MESSAGE, _qualified(), *[listed(F.col(c)) for c in ("added", "removed", "changed_types")])
    details = F.to_json(F.struct(
        F.col("added").alias("added_columns"), F.col("removed").alias("removed_columns"),
        F.col("changed_types").alias("changed_type_columns"),
    ))
    return _alerts(diff.where("has_drift"), "schema_drift", F.lit("critical"), message, details, at)


def snapshots_to_record(current: DataFrame, diff: DataFrame, at) -> DataFrame:
    """Snapshot rows for tables seen for the first time or changed since their last snapshot."""
    due = diff.where("has_drift or not has_prior_snapshot").select(*TABLE_KEY)
    return current.join(due, TABLE_KEY, "left_semi").withColumn("snapshotted_at", moment(at))


# --- alerts ----------------------------------------------------------------------------------------------------------

def _alerts(rows: DataFrame, kind: str, severity: Column, message: Column, details: Column, at) -> DataFrame:
    return rows.select(
        F.lit(kind).alias("alert_type"), severity.alias("severity"), *TABLE_KEY, message.alias("message"),
        details.alias("details"), moment(at).alias("timestamp"),
    )


def alerts_as_json(alerts: DataFrame) -> DataFrame:
    """One JSON object per alert, ready for a text sink."""
    stamp = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp")
    return alerts.select(F.to_json(F.struct(*ALERT_COLUMNS[:-1], stamp)).alias("value"))


def checks(
    stats: DataFrame, columns: DataFrame, baselines: DataFrame, snapshots: DataFrame, as_of,
) -> dict[str, Callable[[], dict[str, DataFrame]]]:
    """The monitors by name, each with its alerts and the rows it wants stored, built when it is called.

    ``stats`` has one row per table (``table_stats``), ``columns`` the live columns of all tables (``schema_rows``).
    """
    def counts() -> dict[str, DataFrame]:
        found = count_check(stats, baselines)
        return {"alerts": count_alerts(found, as_of), "baselines": first_baselines(found, as_of)}

    def freshness() -> dict[str, DataFrame]:
        found = freshness_check(stats, as_of)
        return {"alerts": freshness_alerts(found, as_of), "freshness": found.drop("hours_since_load")}

    def schemas() -> dict[str, DataFrame]:
        diff = schema_diff(columns, latest_snapshot(snapshots))
        return {"alerts": schema_alerts(diff, as_of), "snapshots": snapshots_to_record(columns, diff, as_of)}

    return {"counts": counts, "freshness": freshness, "schemas": schemas}


def live_schemas(tables: Mapping[str, DataFrame], schema: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [schema_rows(df, schema, name) for name, df in tables.items()])


def run_checks(
    tables: Mapping[str, DataFrame], schema: str, baselines: DataFrame, snapshots: DataFrame, as_of,
) -> dict[str, DataFrame]:
    """All monitors over a set of tables: the alerts and the rows each monitor wants stored.

    Every table is scanned once. A check that cannot be planned, for example because a monitoring table lacks a column,
    is logged and left out; the other checks still run. ``plans.monitoring`` runs them apart and stores what they find.
    """
    stats = table_stats(tables, schema)
    stats = stats.sparkSession.createDataFrame(stats.collect(), stats.schema)  # one row per table
    results: dict[str, DataFrame] = {}
    for name, check in checks(stats, live_schemas(tables, schema), baselines, snapshots, as_of).items():
        try:
            found = check()
            found["alerts"].schema  # analysed now, so that a broken check fails here and not in the union below
        except Exception:
            logger.exception("check %s failed", name)
            continue
        if "alerts" in results:
            found["alerts"] = results["alerts"].unionByName(found["alerts"])
        results.update(found)
    return results
