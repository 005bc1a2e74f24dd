"""Start, drain and read back streaming queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from caselight.session import shared_dir

STATE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_table_stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A Parquet table of a folder as a file stream; its schema comes from the file footers."""
    schema = spark.read.parquet(f"{sf}/{name}.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf)


def start_table(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Write a stream to Parquet; every run takes what is there now and stops, the checkpoint carries on from there."""
    return (
        df.writeStream.outputMode(mode).format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def start_batches(
    df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Hand each micro-batch to a function: all that is there now, or endlessly at an interval such as '300 seconds'.

    A batch may be handed over again after a failure, so ``handle`` has to be repeatable.
    """
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return df.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def drain(df: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run a stream over what is there now into the shared folder and return what it wrote."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    start_table(df, f"{path}/rows", f"{path}/checkpoint", mode).awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{path}/rows")
