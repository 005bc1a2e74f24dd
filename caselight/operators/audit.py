"""Safety tier of every statement in a column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from caselight.functions.statements import ALLOWED_TABLES, classify

_TEXT = "__statement"


def audited(df: DataFrame, sql: Column, into: str, allowed: list[str] = ALLOWED_TABLES) -> DataFrame:
    """Add a struct (tier, reason, statement_type, tables) for a statement; each different text is judged once.

    The different texts are merged in the map tasks and joined back, so that a statement that very many rows share costs one
    analysis. On a stream, where that would need state, every row is judged by itself.
    """
    if df.isStreaming:
        return df.withColumn(into, classify(sql, allowed))
    named = df.withColumn(_TEXT, sql)
    judged = named.select(_TEXT).where(F.col(_TEXT).isNotNull()).distinct().withColumn("__found", classify(F.col(_TEXT), allowed))
    nothing = classify(F.lit(None).cast("string"), allowed)
    joined = named.join(judged, _TEXT, "left").withColumn(into, F.coalesce("__found", nothing))
    return joined.select(*[c for c in df.columns if c != into], into)


def audit(df: DataFrame, sql: str = "sql", into: str = "audit", allowed: list[str] = ALLOWED_TABLES) -> DataFrame:
    """``audited`` for the statement in column ``sql``."""
    return audited(df, F.col(sql), into, allowed)
