"""Incremental ingest of report documents into the keyed raw table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from caselight.plans.ingest import Warehouse, load_batch
from caselight.schemas import REPORT_DDL
from caselight.sources.reports import explode_pages, flatten
from caselight.streaming.jobs import start_batches


def document_stream(spark: SparkSession, path: str) -> DataFrame:
    """Files of documents as they arrive."""
    return spark.readStream.schema(REPORT_DDL).json(path)


def page_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Documents of a paged source; the checkpoint holds the cursor."""
    return explode_pages(spark.readStream.format("paged_reports").options(**options).load())


def first_cursor(spark: SparkSession, warehouse: Warehouse, date_range: str) -> dict[str, str]:
    """Options that start a paged source where a table loaded so far left off, for a stream without a checkpoint yet."""
    loaded = warehouse.raw.read(spark).count() if warehouse.raw.exists(spark) else 0
    return {"date_range": date_range, "skip": str(loaded)}


def start_ingest(documents: DataFrame, warehouse: Warehouse, load_date: str, at, checkpoint: str,
                 used_cache: bool = False) -> StreamingQuery:
    """Flatten arriving documents and upsert them; inside a micro-batch the newest received report of a key wins.

    Handing the same micro-batch over twice changes nothing: the upsert is by key, and log rows are written per batch.
    """
    def load(batch: DataFrame, batch_id: int) -> None:
        order = [F.desc_nulls_last("received_date"), F.desc_nulls_last("outcome")]
        load_batch(warehouse, batch, order, at, used_cache, batch_id=f"stream-{batch_id}")

    return start_batches(flatten(documents, load_date), load, checkpoint)
