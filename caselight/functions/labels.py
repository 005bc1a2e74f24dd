"""Display labels and shortened text."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

# Label of each decision, each incident severity by error type.
DECISION_LABELS = {
    "auto_approved": "Auto-Resolved",
    "approved": "Approved",
    "rejected": "Rejected",
    "escalated": "Escalated",
    "pending": "Pending",
}
SEVERITY_BY_TYPE = {
    "data_corruption": "P0",
    "schema_drift": "P1",
    "volume_anomaly": "P1",
    "data_quality": "P2",
    "freshness": "P2",
    "upstream_failure": "P3",
}
DEFAULT_SEVERITY = "P3"
NO_VALUE = "—"
ELLIPSIS = "…"


def lookup(mapping: dict[str, str], key: Column, default: Column) -> Column:
    """Literal map lookup with a default for unknown and null keys."""
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.coalesce(F.when(key.isNotNull(), F.try_element_at(table, key)), default)


def decision_label(fix_result: Column) -> Column:
    return lookup(DECISION_LABELS, fix_result, F.coalesce(F.nullif(fix_result, F.lit("")), F.lit("Unknown")))


def severity(error_type: Column) -> Column:
    return lookup(SEVERITY_BY_TYPE, error_type, F.lit(DEFAULT_SEVERITY))


def run_label(healed: Column, any_failed: Column, all_success: Column) -> Column:
    return (
        F.when(healed, "Healed by AI").when(any_failed, "Failed").when(all_success, "Success").otherwise("Running")
    )


def stage_label(status: Column, healed: Column) -> Column:
    """Label of one stage; a stage without any row has a null status."""
    return (
        F.when(status.isNull(), "Skipped")
        .when(healed, "AI Healed")
        .when(status == "failed", "Failed")
        .when(status == "success", "Success")
        .otherwise("Running")
    )


def duration_label(seconds: Column) -> Column:
    """``Xm YYs`` from a minute up, ``Zs`` below, a dash when unknown."""
    whole = seconds.cast("bigint")
    return (
        F.when(whole.isNull(), NO_VALUE)
        .when(whole >= 60, F.format_string("%dm %02ds", F.floor(whole / 60), F.pmod(whole, F.lit(60))))
        .otherwise(F.concat(whole.cast("string"), F.lit("s")))
    )


def shorten(text: Column, limit: int, keep: int) -> Column:
    """Text up to ``limit`` characters as is; longer text cut to ``keep`` characters and an ellipsis."""
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, keep), F.lit(ELLIPSIS))).otherwise(text)


def or_dash(text: Column) -> Column:
    """The text, or a dash when it is null or empty."""
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(NO_VALUE))
