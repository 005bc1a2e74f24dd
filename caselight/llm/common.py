"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from caselight.session import shared_dir, ship_package

ship_package()  # functions of this package reach Python workers by value; it need not be installed there

#: Characters that separate words: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write below the shared folder and read back: cuts lineage, gives the optimiser true sizes, survives executors."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def words(text: Column) -> Column:
    """The words of a text in order; an empty list for null or blank text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def same(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    """Equality of several columns in which nulls are equal to each other."""
    condition = F.lit(True)
    for name in columns:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


#: Size up to which a table with one row per document is sent to all executors; beyond it the join shuffles.
BROADCAST_BYTES, BROADCAST_ROWS = 32_000_000, 500_000


def wide_key(id_value: Column, text: Column) -> Column:
    """128 bits that rows share only if they repeat both id and text (null as empty), as a struct of two numbers."""
    text = F.coalesce(text, F.lit(""))
    return F.struct(F.xxhash64(id_value, text).alias("a"), F.xxhash64(text, F.lit(1), id_value).alias("b"))


def wrapped(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Each row as it is in a struct ``row``, beside its ``key`` and ``id``: no column of the table can clash with those."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return docs.select(whole, wide_key(F.col(id_col), F.col(text_col)).alias("key"), F.col(id_col).alias("id"))


def keyed(docs: DataFrame, id_col: str, text_col: str, name: str = "__key") -> DataFrame:
    """Append a key that rows share only if they repeat both id and text (null as empty)."""
    return docs.withColumn(name, F.xxhash64(F.col(id_col), F.coalesce(F.col(text_col), F.lit(""))))


def attach(docs: DataFrame, side: DataFrame, on: str, how: str, size: Column | None = None) -> DataFrame:
    """Join a stored table with one row per key to the documents; a small one, by its measured size, is broadcast.

    The limits hold at every size of the corpus; the result does not depend on which way the join takes.
    """
    rows, held = side.agg(F.count("*"), F.sum(size if size is not None else F.lit(16))).first()
    small = rows <= BROADCAST_ROWS and (held or 0) <= BROADCAST_BYTES
    return docs.join(F.broadcast(side) if small else side, on, how)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once for each row."""
    return F.element_at(F.transform(F.array(value), body), 1)
