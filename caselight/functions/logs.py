"""Error logs: the message line and a first guess at the error type."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

TRACEBACK_MARKER = "Traceback (most recent call last):"

# Error-type patterns, tried in this order without regard to case.
HINT_PATTERNS = [
    ("schema_drift",
     r"missing columns|does not exist.*column|column.*does not exist|schema validation failed|rename column"),
    ("upstream_failure",
     r"nosuchkey|s3 object.*does not exist|out of memory|sigkill|connection refused|timeout|i/o error"
     r"|input/output error"),
    ("volume_anomaly", r"row count|deviat|zero rows extracted|deleted \d+ rows"),
    ("data_quality", r"null|missing value|drug_name.*null|out-of-range|bad_serious"),
]


def strip(text: Column) -> Column:
    """Remove white space of any kind at both ends (``trim`` removes spaces only)."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def error_message(log_text: Column) -> Column:
    """The last non-blank line of a log that contains a traceback, otherwise the whole log."""
    lines = F.filter(F.split(log_text, r"\r\n|\r|\n"), lambda line: strip(line) != "")
    return F.when(log_text.contains(TRACEBACK_MARKER), strip(F.element_at(lines, -1))).otherwise(strip(log_text))


def error_type_hint(message: Column) -> Column:
    """First matching error type, or null."""
    hint = F.lit(None).cast("string")
    for error_type, pattern in reversed(HINT_PATTERNS):
        hint = F.when(message.rlike("(?i)" + pattern), error_type).otherwise(hint)
    return hint
