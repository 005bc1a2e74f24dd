"""What a load and the stream that feeds it leave on disk."""

import json
import os
import time

from pyspark.sql import DataFrame, functions as F

from caselight.bindings import catalog, inputs
from caselight.plans.ingest import Warehouse, load_batch
from caselight.schemas import LANDING_COLUMNS
from caselight.streaming import ingest
from tests.helpers import rows

def newest():
    return [F.desc_nulls_last("received_date"), F.desc_nulls_last("outcome")]


def landed(spark, *reports):
    values = [[(report | {"load_date": "2024-03-01"}).get(name) for name in LANDING_COLUMNS] for report in reports]
    return spark.createDataFrame(values, ", ".join(f"{name} string" for name in LANDING_COLUMNS))


def shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().iterator()
    found = set()
    while files.hasNext():
        name = files.next().getName()
        if name.startswith("shuffle_"):
            found.add(name)
    return found


def test_a_load_caches_nothing_and_leaves_no_copy_of_its_batch(spark, tmp_path, monkeypatch):
    cached = []
    monkeypatch.setattr(DataFrame, "persist", lambda self, *level: cached.append(level) or self)
    warehouse = Warehouse(str(tmp_path / "w"), buckets=2)
    reports = [{"report_id": str(n), "received_date": "20240101", "drug_name": "x", "reaction": "y", "serious": "1",
                "outcome": "1", "patient_age": "7.5", "country": None if n % 2 else "é,\"\n"} for n in range(20)]
    reports += [reports[0] | {"received_date": "20240102", "drug_name": "later"}, reports[1] | {"report_id": None}]
    assert load_batch(warehouse, landed(spark, *reports), newest(), "2024-03-01 01:00:00", batch_id="one") == 22
    again = [reports[3] | {"drug_name": "changed", "patient_age": "none"}]
    assert load_batch(warehouse, landed(spark, *again), newest(), "2024-03-02 01:00:00", batch_id="two") == 1
    expected = {n: ("x", 7.5, reports[n]["country"]) for n in range(20)}
    expected |= {0: ("later", 7.5, reports[0]["country"]), 3: ("changed", None, reports[3]["country"])}
    found = {int(r["report_id"]): (r["drug_name"], r["patient_age"] and float(r["patient_age"]), r["country"])
             for r in warehouse.raw.read(spark).collect()}
    assert found == expected
    assert cached == []
    assert sorted(os.listdir(tmp_path / "w")) == ["loading", "monitoring", "raw"]
    assert os.listdir(tmp_path / "w" / "loading" / "case_reports") == []


def test_a_load_leaves_no_shuffle_files(spark, tmp_path):
    source, warehouse = tmp_path / "in", Warehouse(str(tmp_path / "w"), buckets=4)
    source.mkdir()
    before, setting = shuffle_files(spark), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    for step in range(2):
        reports = [{"safetyreportid": str(n), "serious": "1", "receiptdate": f"2024010{step + 1}"} for n in range(500)]
        (source / f"{step}.json").write_text("\n".join(map(json.dumps, reports)))
        documents = ingest.document_stream(spark, str(source))
        ingest.start_ingest(documents, warehouse, "2024-03-01", "2024-03-01 00:00:00", str(tmp_path / "c")).awaitTermination()
    until = time.time() + 10
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left
    assert warehouse.raw.read(spark).where("received_date = '20240102'").count() == 500
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == setting


def test_the_documents_of_the_stream_are_compressed(spark, sf, monkeypatch):
    folders = []
    opened = ingest.document_stream
    monkeypatch.setattr(ingest, "document_stream", lambda spark, path: folders.append(path) or opened(spark, path))
    found = catalog.QUERIES["stream_ingest"](spark, sf)
    text = inputs.nested_reports(spark, sf).agg(F.count("json"), F.sum(F.octet_length("json"))).first()
    files = [os.path.join(folders[0], name) for name in os.listdir(folders[0]) if name.startswith("part-")]
    assert sum(map(os.path.getsize, files)) < text[1] / 3
    # Readers see every document: those of the first drop, and the recent ones of the second.
    lines = spark.read.text(folders[0])
    assert len(rows(found)) == text[0] == lines.where("value like '%\"serious\":\"9\"%'").count() < lines.count()
