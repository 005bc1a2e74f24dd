"""Data drills: repeatable damage to a table that the monitors must notice, and the way back."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from caselight.functions.measures import moment
from caselight.operators.selection import Cut, select_fraction, select_fractions
from caselight.schemas import RAW_COLUMNS

logger = logging.getLogger(__name__)

# Size and spelling of the damage.
DROP_FRACTION = 0.6
NULL_FRACTION = 0.1
BAD_CODE_FRACTION = 0.05
BAD_CODE = "-999"
DRIFTED_NAME = "medication_name"
MOVED_NAME = "drug_brand_nm"
STALE_DAYS = 3


def drop_rows(df: DataFrame, keys: Sequence[str], seed: int, fraction: float = DROP_FRACTION,
              rounding: str = "ceil") -> DataFrame:
    """Delete an exact share of the rows."""
    return df.where(~select_fraction(df, keys, fraction, seed, rounding))


def null_values(df: DataFrame, column: str, keys: Sequence[str], seed: int, fraction: float = NULL_FRACTION,
                rounding: str = "ceil", minimum: int = 0) -> DataFrame:
    """Blank a column on an exact share of the rows."""
    return _blank(df, column, select_fraction(df, keys, fraction, seed, rounding, minimum))


def bad_codes(df: DataFrame, column: str, keys: Sequence[str], seed: int, fraction: float = BAD_CODE_FRACTION,
              code: str = BAD_CODE) -> DataFrame:
    """Put an impossible code on an exact share of the rows, one row at least."""
    return _overwrite(df, column, select_fraction(df, keys, fraction, seed, "floor", 1), code)


def _blank(df: DataFrame, column: str, hit: Column) -> DataFrame:
    return df.withColumn(column, F.when(~hit, F.col(column)))


def _overwrite(df: DataFrame, column: str, hit: Column, code: str = BAD_CODE) -> DataFrame:
    return df.withColumn(column, F.when(hit, F.lit(code)).otherwise(F.col(column)))


def rename(df: DataFrame, column: str = "drug_name", name: str = DRIFTED_NAME) -> DataFrame:
    """Rename a column in place; nothing happens when it is already gone."""
    return df.withColumnRenamed(column, name) if column in df.columns else df


def move(df: DataFrame, column: str = "drug_name", name: str = MOVED_NAME) -> DataFrame:
    """Rename by copying to a new last column and dropping the old one."""
    return df.withColumn(name, F.col(column)).drop(column) if column in df.columns else df


def make_stale(df: DataFrame, as_of, column: str = "loaded_at", days: int = STALE_DAYS) -> DataFrame:
    """Pretend that every row was loaded some days before ``as_of``."""
    return df.withColumn(column, moment(as_of) - F.expr(f"interval {days} days"))


def restore(backup: DataFrame, columns: Sequence[str] = RAW_COLUMNS) -> DataFrame:
    """Rows and schema of the snapshot taken before the first drill."""
    return backup.select(*columns)


#: The selections of each scenario, given the seed of the run.
CUTS = {
    "volume_anomaly": lambda seed: [Cut(DROP_FRACTION, seed)],
    "data_quality": lambda seed: [Cut(NULL_FRACTION, seed, "floor", 1), Cut(BAD_CODE_FRACTION, seed + 1, "floor", 1)],
}
SCENARIOS = ("volume_anomaly", "data_quality", "schema_drift", "freshness_failure")


def run_drills(scenarios: Sequence[str], df: DataFrame, keys: Sequence[str], as_of, seed: int = 0) -> DataFrame:
    """Damage a table according to several scenarios at once; unknown names and ``none`` leave it alone.

    The selections of all scenarios are made on the table as it is, together, with two passes over its keys. Rows are dropped
    and columns renamed after the values were damaged, in whatever order the scenarios are named.
    """
    for name in scenarios:
        if name not in SCENARIOS and name != "none":
            logger.warning("unknown drill %r, nothing done", name)
    wanted = [(name, cut) for name in dict.fromkeys(scenarios) for cut in CUTS.get(name, lambda _: [])(seed)]
    hits: dict[str, list[Column]] = {}
    for (name, _), hit in zip(wanted, select_fractions(df, keys, [cut for _, cut in wanted]) if wanted else []):
        hits.setdefault(name, []).append(hit)
    if "data_quality" in hits:
        nulls, codes = hits["data_quality"]
        df = _overwrite(_blank(df, "drug_name", nulls), "serious", codes)
    if "freshness_failure" in scenarios:
        df = make_stale(df, as_of)
    if "volume_anomaly" in hits:
        df = df.where(~hits["volume_anomaly"][0])
    return move(df) if "schema_drift" in scenarios else df


def run_drill(scenario: str, df: DataFrame, keys: Sequence[str], as_of, seed: int = 0) -> DataFrame:
    """``run_drills`` for one scenario."""
    return run_drills([scenario], df, keys, as_of, seed)
