"""Column rules over a table, evaluated in one pass, and the gate that stops a run."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from caselight.functions.codes import parse_day
from caselight.schemas import RAW_LENGTHS


class DataQualityError(RuntimeError):
    """A rule failed; the message names the failing rules."""


class MissingColumnsError(ValueError):
    """A batch lacks required columns."""


@dataclass(frozen=True)
class Rule:
    """A named check of one column.

    ``bad`` builds the condition that marks failing rows; a unique rule has none and counts keys instead.
    """

    column: str
    kind: str
    bad: Callable[[], Column] | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.column}"


def not_null(column: str) -> Rule:
    return Rule(column, "not_null", lambda: F.col(column).isNull())


def unique(column: str) -> Rule:
    return Rule(column, "unique")


def accepted_values(column: str, values: Sequence[str]) -> Rule:
    """Nulls pass."""
    return Rule(column, "accepted_values", lambda: F.coalesce(~F.col(column).isin(list(values)), F.lit(False)))


def max_length(column: str, limit: int) -> Rule:
    return Rule(column, "max_length", lambda: F.coalesce(F.length(column) > limit, F.lit(False)))


def valid_day(column: str) -> Rule:
    """Blank text passes, text that is no ``yyyyMMdd`` date fails."""
    return Rule(column, "valid_day",
                lambda: F.coalesce((F.trim(column) != "") & parse_day(F.col(column)).isNull(), F.lit(False)))


# The rules declared for the raw and the staged table.
RAW_RULES = [not_null("report_id"), not_null("received_date"), not_null("drug_name"), not_null("reaction")]
STAGED_RULES = [
    not_null("report_id"), unique("report_id"), not_null("drug_name"), not_null("reaction"),
    accepted_values("patient_sex", ["1", "2"]),
]
RAW_LENGTH_RULES = [max_length(column, limit) for column, limit in RAW_LENGTHS.items()]


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one row and their row count; null keys do not count as duplicates."""
    keyed = df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    return keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def run_rules(df: DataFrame, rules: Iterable[Rule], table: str, exclude: Iterable[str] = ()) -> DataFrame:
    """One row per rule: table, column, rule, number of failures, passed.

    All row-level rules share a single aggregate over the table; each unique rule adds one aggregate by its key, merged
    per map task before the shuffle, so a key that repeats very often costs nothing extra.
    """
    skipped = set(exclude)
    chosen = [rule for rule in rules if rule.name not in skipped]
    row_rules = [rule for rule in chosen if rule.bad is not None]
    results = []
    if row_rules:
        counts = df.agg(*[F.count_if(rule.bad()).alias(rule.name) for rule in row_rules])
        results.append(counts.select(F.inline(F.array(*[
            F.struct(F.lit(rule.column).alias("column_name"), F.lit(rule.kind).alias("rule"),
                     F.col(rule.name).alias("failures"))
            for rule in row_rules
        ]))))
    for rule in chosen:
        if rule.bad is None:
            failures = duplicate_keys(df, [rule.column]).agg(F.count(F.lit(1)).alias("failures"))
            results.append(failures.select(
                F.lit(rule.column).alias("column_name"), F.lit(rule.kind).alias("rule"), "failures"
            ))
    report = reduce(DataFrame.unionByName, results)
    return report.select(
        F.lit(table).alias("table_name"), "column_name", "rule", "failures", (F.col("failures") == 0).alias("passed")
    )


def gate(report: DataFrame) -> None:
    """Raise when any rule of a report failed. The report has one row per rule, so reading it is safe."""
    failed = report.where(~F.col("passed")).orderBy("table_name", "rule", "column_name").collect()
    if failed:
        lines = [f"{r['table_name']}.{r['column_name']}: {r['rule']} failed for {r['failures']}" for r in failed]
        raise DataQualityError("\n".join(lines))


def null_rates(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows, nulls and null percentage of each column, one scan for all of them; 0 percent for an empty table.

    ``by`` names columns that tell tables apart when ``df`` holds the rows of several.
    """
    grouped = df.groupBy(*by) if by else df
    total = grouped.agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(F.col(c).isNull()).alias(f"__{c}") for c in columns])
    rows = total.select(*by, F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col("__n").alias("total_rows"), F.col(f"__{c}").alias("null_rows"))
        for c in columns
    ])))
    rate = F.when(F.col("total_rows") > 0, F.round(F.col("null_rows") / F.col("total_rows") * 100, 2)).otherwise(0.0)
    return rows.withColumn("null_pct", rate)


def missing_columns(actual: Iterable[str], required: Iterable[str]) -> list[str]:
    return sorted(set(required) - set(actual))


def require_names(actual: Iterable[str], required: Iterable[str]) -> None:
    """Raise with the missing and the actual names when a required name is absent."""
    actual = sorted(actual)
    missing = missing_columns(actual, required)
    if missing:
        raise MissingColumnsError(f"Schema validation FAILED.\nMissing columns: {missing}\nActual columns: {actual}")


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """The frame itself, if it has all required columns."""
    require_names(df.columns, required)
    return df


def quarantine(df: DataFrame, rules: Iterable[Rule]) -> tuple[DataFrame, DataFrame]:
    """Split a frame into rows that pass every row-level rule and rows that fail some, with the rule names."""
    failed = F.array_compact(F.array(*[F.when(rule.bad(), rule.name) for rule in rules if rule.bad is not None]))
    marked = df.withColumn("failed_rules", failed)
    return marked.where(F.size("failed_rules") == 0).drop("failed_rules"), marked.where(F.size("failed_rules") > 0)
