"""Coded text fields: flags, code spelling, dates and ages."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Spellings of "no value" that a dataframe-written CSV may contain.
NULL_TOKENS = ["", "NaN", "nan", "None", "null"]


def flag(code: Column) -> Column:
    """True for code 1, null when the code is missing or blank, false for any other code."""
    return F.nullif(F.trim(code), F.lit("")) == "1"


def strict_flag(code: Column) -> Column:
    """True for code 1, false otherwise, never null."""
    return F.coalesce(F.trim(code) == "1", F.lit(False))


def normalize_code(code: Column, null_tokens: list[str] = NULL_TOKENS) -> Column:
    """Undo float spelling of integer codes (``1.0`` to ``1``) and turn null spellings into nulls."""
    bare = F.regexp_replace(F.trim(code), r"^(-?\d+)\.0+$", "$1")
    return F.when(~bare.isin(null_tokens), bare)


def parse_day(text: Column) -> Column:
    """Date from ``yyyyMMdd`` text; null for blank or impossible dates (see quality.quarantine for the rejects)."""
    return F.try_to_date(F.nullif(F.trim(text), F.lit("")), "yyyyMMdd")


def age(value: Column) -> Column:
    """Age as a decimal. Text that is no number, and NaN, become null so that averages stay defined."""
    return F.nanvl(value.try_cast("double"), F.lit(None).cast("double")).try_cast("decimal(10,2)")
