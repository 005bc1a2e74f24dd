"""Date windows of a paged source: how they step back in time, split when too large, and which pages they have."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

# Limits and window format of the upstream service.
PAGE_LIMIT = 100
SKIP_CAP = 25_000
EARLIEST_YEAR = 2004
WINDOW_PATTERN = r"receiptdate:\[(\d{8}) TO (\d{8})\]"
WINDOW_FORMAT = "receiptdate:[%08d TO %08d]"

#: Days are numbers yyyymmdd here, so a year is this far away.
_YEAR = 10_000


def days_of(window: str) -> tuple[int, int]:
    """First and last day of a window as numbers yyyymmdd."""
    found = re.fullmatch(WINDOW_PATTERN, window)
    if found is None:
        raise ValueError(f"no window of days: {window!r}")
    return int(found[1]), int(found[2])


def years_back(window: str, years: int = 1) -> str:
    """The same month and day, some years before."""
    return WINDOW_FORMAT % tuple(day - years * _YEAR for day in days_of(window))


def steps_back(window: str, earliest: int = EARLIEST_YEAR) -> int:
    """How many whole years a window can go back; never below none."""
    return max(0, days_of(window)[0] // _YEAR - earliest)


def halves(window: str) -> list[str]:
    """Two windows that make up one; raises ValueError for a single day."""
    first, last = (dt.datetime.strptime(str(day), "%Y%m%d").date() for day in days_of(window))
    if first >= last:
        raise ValueError(f"{window!r} is one day and cannot be split")
    middle = first + (last - first) // 2
    parts = [(first, middle), (middle + dt.timedelta(days=1), last)]
    return [WINDOW_FORMAT % tuple(int(day.strftime("%Y%m%d")) for day in part) for part in parts]


def windows_back(spark: SparkSession, window: str, earliest: int = EARLIEST_YEAR) -> DataFrame:
    """A window and all windows before it, newest first: (position, date_range, start_year)."""
    first, last = days_of(window)
    back = spark.range(steps_back(window, earliest) + 1).withColumnRenamed("id", "position")
    day = lambda start: (F.lit(start) - F.col("position") * _YEAR).cast("int")
    return back.select(
        F.col("position").cast("int").alias("position"),
        F.format_string(WINDOW_FORMAT, day(first), day(last)).alias("date_range"),
        (F.lit(first // _YEAR) - F.col("position")).cast("int").alias("start_year"))


def fit_windows(daily: DataFrame, cap: int = SKIP_CAP) -> DataFrame:
    """(date_range, total) such that no window exceeds ``cap``, from (date_range, day, total).

    A window that fits stays whole; another is cut between days wherever its running total passes the cap less its
    largest day. A day above the cap fails the job: the service cannot hand it out.
    """
    whole = Window.partitionBy("date_range")
    sums = daily.groupBy("date_range", "day").agg(F.sum("total").alias("total")).withColumns({
        "all": F.sum("total").over(whole), "most": F.max("total").over(whole),
        "before": F.sum("total").over(whole.orderBy("day")) - F.col("total")})
    too_much = F.raise_error(F.concat(F.lit("more rows than the service serves on day "), F.col("day").cast("string")))
    step = F.when(F.col("most") > cap, too_much.cast("bigint")).otherwise(F.greatest(F.lit(1), cap - F.col("most")))
    part = F.when(F.col("all") <= cap, F.lit(0)).otherwise(F.floor(F.col("before") / step))
    number = lambda which: F.date_format(which("day"), "yyyyMMdd").cast("int")
    fitted = sums.withColumn("part", part).groupBy("date_range", "part").agg(
        F.sum("total").alias("total"), F.first("all").alias("all"),
        F.format_string(WINDOW_FORMAT, number(F.min), number(F.max)).alias("narrow"))
    return fitted.select(F.when(F.col("all") <= cap, F.col("date_range")).otherwise(F.col("narrow")).alias("date_range"), "total")


def page_plan(totals: DataFrame, limit: int = PAGE_LIMIT, cap: int = SKIP_CAP) -> DataFrame:
    """Every page to fetch, (date_range, skip, limit), from (date_range, total).

    An empty window has no pages. A window above ``cap`` fails the job, see ``fit_windows``.
    """
    refused = F.raise_error(F.concat(F.lit("more rows than the service serves in "), F.col("date_range"))).cast("bigint")
    total = F.when(F.col("total") > cap, refused).otherwise(F.col("total"))
    skips = F.when(total > 0, F.sequence(F.lit(0).cast("bigint"), total - 1, F.lit(limit).cast("bigint")))
    return totals.select("date_range", F.explode(skips).alias("skip"), F.lit(limit).alias("limit"))
