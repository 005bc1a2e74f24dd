"""Verified column renames: detect and undo a rename by comparing live columns with the declared ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from caselight.operators.monitors import TABLE_KEY
from caselight.schemas import RAW_COLUMNS

# Wording of the note about a rename.
RENAMED = "Renamed column '%s' back to '%s'."


def rename_candidates(live: DataFrame, declared: DataFrame) -> DataFrame:
    """For each live table the one safe rename, if there is one.

    A rename is safe when exactly one declared column is missing and exactly one live column is undeclared. Both inputs
    hold (schema_name, table_name, column_name); they are grouped by column in one shuffle. The result has
    ``extra_count``, ``missing_count`` and, only for a safe rename, ``current_name`` and ``canonical_name``.
    """
    sides = live.select(*TABLE_KEY, "column_name", F.lit(True).alias("live"), F.lit(False).alias("declared")).unionByName(
        declared.select(*TABLE_KEY, "column_name", F.lit(False).alias("live"), F.lit(True).alias("declared"))
    )
    columns = sides.groupBy(*TABLE_KEY, "column_name").agg(
        F.bool_or("live").alias("live"), F.bool_or("declared").alias("declared")
    )
    extra, missing = F.col("live") & ~F.col("declared"), F.col("declared") & ~F.col("live")
    tables = columns.groupBy(*TABLE_KEY).agg(
        F.count_if(extra).alias("extra_count"),
        F.count_if(missing).alias("missing_count"),
        F.max(F.when(extra, F.col("column_name"))).alias("current_name"),
        F.max(F.when(missing, F.col("column_name"))).alias("canonical_name"),
        F.bool_or("live").alias("is_live"),
    ).where("is_live").drop("is_live")
    safe = (F.col("extra_count") == 1) & (F.col("missing_count") == 1)
    return tables.withColumns({
        name: F.when(safe, F.col(name)) for name in ("current_name", "canonical_name")
    })


def safe_rename(columns: Sequence[str], declared: Sequence[str] = RAW_COLUMNS) -> tuple[str, str] | None:
    """(current, canonical) name of the safe rename of one frame, from its schema alone."""
    extra, missing = set(columns) - set(declared), set(declared) - set(columns)
    return (extra.pop(), missing.pop()) if len(extra) == 1 and len(missing) == 1 else None


def apply_safe_rename(df: DataFrame, declared: Sequence[str] = RAW_COLUMNS) -> tuple[DataFrame, str | None]:
    """The frame with its safe rename undone and a sentence about it, or the frame as it is and None."""
    found = safe_rename(df.columns, declared)
    if found is None:
        return df, None
    current, canonical = found
    return df.withColumnRenamed(current, canonical), RENAMED % (current, canonical)
