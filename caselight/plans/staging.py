"""The typed view over the raw table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from caselight.functions.codes import age, flag, normalize_code, parse_day, strict_flag

CODE_COLUMNS = ["serious", "serious_death", "serious_hosp", "serious_life", "patient_sex", "outcome"]

# Output column: expression over the raw columns.
STAGED = {
    "report_id": lambda: F.trim("report_id"),
    "received_date": lambda: parse_day(F.col("received_date")),
    "serious": lambda: flag(F.col("serious")),
    "serious_death": lambda: flag(F.col("serious_death")),
    "serious_hosp": lambda: flag(F.col("serious_hosp")),
    "serious_life": lambda: flag(F.col("serious_life")),
    "patient_age": lambda: age(F.col("patient_age")),
    "patient_age_unit": lambda: F.trim("patient_age_unit"),
    "patient_sex": lambda: F.trim("patient_sex"),
    "drug_name": lambda: F.upper(F.trim("drug_name")),
    "drug_indication": lambda: F.trim("drug_indication"),
    "reaction": lambda: F.lower(F.trim("reaction")),
    "outcome": lambda: F.trim("outcome"),
    "country": lambda: F.trim("country"),
    "is_serious": lambda: strict_flag(F.col("serious")),
    "is_fatal": lambda: strict_flag(F.col("serious_death")),
    "loaded_at": lambda: F.col("loaded_at"),
    "load_date": lambda: F.col("load_date"),
}


def stage_reports(raw: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Typed reports; rows without a report id are left out. ``columns`` limits the output to what is needed."""
    keyed = raw.where(F.col("report_id").isNotNull() & (F.trim("report_id") != ""))
    return keyed.select(*[STAGED[name]().alias(name) for name in columns or STAGED])


def normalize_codes(raw: DataFrame, columns: Sequence[str] = tuple(CODE_COLUMNS)) -> DataFrame:
    """Optional step before staging for files whose integer codes were written as floats."""
    return raw.withColumns({name: normalize_code(F.col(name)) for name in columns if name in raw.columns})
