"""Nested report documents and page envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from caselight.schemas import PAGE_DDL, REPORT_DDL


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Report documents, one JSON object per line, read with the fixed schema (no inference pass)."""
    return spark.read.schema(REPORT_DDL).json(path)


def parse_documents(df: DataFrame, text: str = "json") -> DataFrame:
    """Report documents from a text column."""
    return df.select(F.from_json(text, REPORT_DDL).alias("report")).select("report.*")


def explode_pages(pages: DataFrame, text: str = "page") -> DataFrame:
    """One row per report of each page envelope; a page without results gives none."""
    parsed = pages.select(F.from_json(text, PAGE_DDL).alias("page"))
    return parsed.select(F.explode("page.results").alias("report")).select("report.*")


def page_total(page: Column) -> Column:
    """Number of reports that match the window of a page, 0 when the page does not say."""
    return F.coalesce(F.get_json_object(page, "$.meta.results.total").cast("bigint"), F.lit(0))


def flatten(reports: DataFrame, load_date: str | Column) -> DataFrame:
    """The fifteen landing columns of each document: its first drug, its first reaction, null for what is missing."""
    drug = F.get(F.col("patient.drug"), F.lit(0))
    reaction = F.get(F.col("patient.reaction"), F.lit(0))
    # Which document field becomes which column.
    fields = {
        "report_id": F.col("safetyreportid"),
        "received_date": F.col("receiptdate"),
        "serious": F.col("serious"),
        "serious_death": F.col("seriousnessdeath"),
        "serious_hosp": F.col("seriousnesshospitalization"),
        "serious_life": F.col("seriousnesslifethreatening"),
        "patient_age": F.col("patient.patientonsetage"),
        "patient_age_unit": F.col("patient.patientonsetageunit"),
        "patient_sex": F.col("patient.patientsex"),
        "drug_name": drug["medicinalproduct"],
        "drug_indication": drug["drugindication"],
        "reaction": reaction["reactionmeddrapt"],
        "outcome": reaction["reactionoutcome"],
        "country": F.col("primarysource.reportercountry"),
        "load_date": F.lit(load_date) if isinstance(load_date, str) else load_date,
    }
    return reports.select(*[value.alias(name) for name, value in fields.items()])
