"""Flat landing files: CSV folders by load date and batch.

A batch counts once it was read back and recorded in the log of batches beside the folder. What is not recorded, half
written or empty, is never taken for the newest batch.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from caselight.schemas import LANDING_COLUMNS, LANDING_DDL
from caselight.sources.tables import append, read_log

# Quotes are doubled inside quoted text, as other CSV writers do. Empty text and null are one and the same in a file.
CSV = {
    "header": "true", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false", "multiLine": "true",
}
LISTED = 20
BATCHES_DDL = "load_date string, batch_id string, rows bigint, at timestamp"


class LandingError(RuntimeError):
    """A landing file cannot be read back as it was written."""


def batch_path(path: str, load_date: str, batch_id: str) -> str:
    return f"{path.rstrip('/')}/load_date={load_date}/batch_id={batch_id}"


def batches(spark: SparkSession, path: str) -> DataFrame:
    """The batches that landed whole, (load_date, batch_id, rows); a batch that is being written again is not one."""
    log = read_log(spark, f"{path.rstrip('/')}_batches", BATCHES_DDL)
    last = log.groupBy("load_date", "batch_id").agg(F.max_by("rows", "at").alias("rows"))
    return last.where("rows > 0")


def _record(spark: SparkSession, path: str, load_date: str, batch_id: str, rows: int | None) -> None:
    row = spark.createDataFrame([(load_date, batch_id, rows)], "load_date string, batch_id string, rows bigint")
    append(row.withColumn("at", F.current_timestamp()), f"{path.rstrip('/')}_batches")


def write_landing(df: DataFrame, path: str, load_date: str, batch_id: str) -> int:
    """Write one batch, read it back and record it; returns its row count. An empty batch is not recorded.

    The folder carries the batch id as well as the date, so two loads on one day do not overwrite each other, while
    writing the same batch again replaces it. The rows are counted while they are written (no extra pass over the
    input) and compared with what a reader sees.
    """
    spark, target = df.sparkSession, batch_path(path, load_date, batch_id)
    _record(spark, path, load_date, batch_id, None)
    written = Observation()
    counted = df.observe(written, F.count(F.lit(1)).alias("rows"))
    counted.drop("load_date").write.mode("overwrite").options(**CSV).csv(target)
    wanted = written.get["rows"]
    if wanted == 0:
        return 0
    visible = _reader(spark).csv(target).count()
    if visible != wanted:
        raise LandingError(f"{target}: wrote {wanted} rows but {visible} are visible")
    _record(spark, path, load_date, batch_id, visible)
    return visible


def _reader(spark: SparkSession):
    ddl = ", ".join(f"{name} string" for name in LANDING_COLUMNS if name != "load_date")
    return spark.read.options(**CSV).schema(ddl)


def read_batch(spark: SparkSession, path: str, load_date: str, batch_id: str) -> DataFrame:
    """One batch as text columns. Raises FileNotFoundError that tells what is there instead."""
    target = batch_path(path, load_date, batch_id)
    if list_files(spark, target).isEmpty():
        raise FileNotFoundError(f"{target} has no landing files; {_holdings(spark, path)}")
    return _reader(spark).csv(target).withColumn("load_date", F.lit(load_date))


def _holdings(spark: SparkSession, path: str) -> str:
    """The files below a folder in words: the first ones by name and how many more there are."""
    files = list_files(spark, path)
    some = [row["path"] for row in files.orderBy("path").limit(LISTED).collect()]
    if not some:
        return f"nothing has landed below {path}"
    more = files.count() - len(some)
    return f"below {path} there are: " + ", ".join(some) + (f" and {more} more" if more else "")


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """All batches as text columns with load_date and batch_id from the folder names."""
    return lower_names(spark.read.options(**CSV).schema(LANDING_DDL + ", batch_id string").csv(path))


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.lower() for name in df.columns])


def header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV file, from its first line."""
    return spark.read.options(**CSV).csv(path).columns


def list_files(spark: SparkSession, path: str, pattern: str = "*.csv") -> DataFrame:
    """Paths of the files below a folder, listed by Spark without reading them; none when the folder is missing."""
    try:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
        return found.load(path).select("path")
    except AnalysisException:
        return spark.createDataFrame([], "path string")


def latest_batch(spark: SparkSession, path: str) -> tuple[str, str]:
    """(load_date, batch_id) of the newest batch that landed whole, the fallback when the source is down.

    Dates and batch ids sort by time, so the greatest pair is the newest.
    """
    newest = batches(spark, path).agg(F.max(F.struct("load_date", "batch_id"))).first()[0]
    if newest is None:
        raise LandingError(f"the source is down and no batch has landed below {path}")
    return newest["load_date"], newest["batch_id"]
