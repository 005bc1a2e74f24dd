"""Incident records from a stream of routed incidents, kept in two places."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from caselight.operators.incidents import incident_records, incident_reports
from caselight.plans.ingest import Warehouse
from caselight.sources.tables import KeyedTable
from caselight.streaming.jobs import start_batches

logger = logging.getLogger(__name__)


def memory_table(warehouse: Warehouse) -> KeyedTable:
    """Incident memory, one record per incident."""
    return KeyedTable(warehouse.path("memory", "incidents"), ("incident_id",))


def report_path(warehouse: Warehouse, batch_id: int) -> str:
    return f"{warehouse.path('monitoring', 'incident_reports')}/batch_id={batch_id}"


def start_records(routed: DataFrame, created_at: str, warehouse: Warehouse, allowed: list[str], checkpoint: str) -> StreamingQuery:
    """Write each micro-batch to the incident memory and, as far as possible, to the reporting table.

    A micro-batch that is handed over again replaces itself in both places: records by incident, report rows by batch.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        records = incident_records(batch, F.col(created_at), allowed).persist()
        try:
            memory_table(warehouse).upsert(records, [F.desc("created_at")])
            try:
                incident_reports(records).write.mode("overwrite").parquet(report_path(warehouse, batch_id))
            except Exception:
                logger.exception("reporting rows of batch %d not written, the memory has them", batch_id)
        finally:
            records.unpersist()

    return start_batches(routed, write, checkpoint)
