"""Registered queries and the SQL that an independent engine runs to check them."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from caselight.bindings.ctes import CTES

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def with_ctes(body: str) -> str:
    """Put the named inputs that a statement uses, and those that these use, in front of it."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in set(re.findall(r"\bx_\w+", text)) - needed:
            if name in CTES:
                needed.add(name)
                visit(CTES[name])

    visit(body)
    recursive = " RECURSIVE" if "/* recursive */" in body else ""
    inputs = [f"{name} AS (\n{CTES[name].strip()}\n)" for name in CTES if name in needed]
    body = body.strip()
    if body.startswith("/* recursive */"):
        body = body.removeprefix("/* recursive */").strip()
    joiner = ",\n" if body.startswith(",") else "\n"
    body = body.removeprefix(",").strip()
    if not inputs:
        return f"WITH{recursive} {body}" if joiner == ",\n" else body
    return f"WITH{recursive} " + ",\n".join(inputs) + joiner + body


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``oracle`` is SQL over the benchmark tables and the named inputs of ``ctes``.

    An oracle that needs further CTEs of its own starts with a comma: ``, mine AS (...) SELECT ...``.
    """
    def register(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, sf: plain(build(spark, sf))
        if oracle is not None:
            ORACLES[name] = with_ctes(oracle)
        return build

    return register


def plain(df: DataFrame) -> DataFrame:
    """Types that any engine prints alike: text for dates, times and lists, double for decimals, bigint for integers."""
    def convert(field: T.StructField):
        column = F.col(f"`{field.name}`")
        kind = field.dataType
        if isinstance(kind, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(kind, T.ArrayType):
            column = F.array_join(column, ",")
        elif isinstance(kind, (T.DecimalType, T.FloatType)):
            column = column.cast("double")
        elif isinstance(kind, T.IntegralType):
            column = column.cast("bigint")
        elif isinstance(kind, T.BooleanType):
            column = column.cast("string")
        return column.alias(field.name)

    return df.select(*[convert(field) for field in df.schema.fields])
