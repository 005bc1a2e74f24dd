"""Event-time counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def load_counts(
    events: DataFrame, time: str, by: list[str], failed: Column, width: str = "1 hour", late: str = "10 minutes"
) -> DataFrame:
    """Rows and failures per window and group; rows later than the watermark are dropped, closed windows are final.

    The aggregate is merged per map task before its shuffle, so one busy group or hour does not overload a task.
    """
    counted = events.withColumn("__failed", failed).withWatermark(time, late).groupBy(
        F.window(time, width), *by
    ).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("__failed").alias("n_failed"))
    return counted.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *by, "n_rows", "n_failed"
    )
