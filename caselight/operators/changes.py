"""Inserts, updates and deletes as transformations of a table's rows.

Each function returns the table after the change; ``sources.tables`` commits such results to storage.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from caselight.functions.measures import moment
from caselight.operators.latest import latest_per_key


_LONE = "__lone"


def _any_null(keys: Sequence[str]) -> Column:
    found = F.lit(False)
    for key in keys:
        found = found | F.col(key).isNull()
    return found


def dedupe_batch(batch: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first under ``order``. Rows without a key conflict with nothing and all stay.

    A row without a key gets a number of its own to be grouped by, which also keeps such rows from piling up in one
    task; which number it is makes no difference to the result.
    """
    lone = F.when(_any_null(keys), F.monotonically_increasing_id())
    return latest_per_key(batch.withColumn(_LONE, lone), [*keys, _LONE], order).drop(_LONE)


def with_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows in which no key column is null."""
    return df.where(~_any_null(keys))


def stamp(df: DataFrame, column: str, at) -> DataFrame:
    return df.withColumn(column, moment(at))


def upsert(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[Column], loaded_at=None
) -> DataFrame:
    """Insert the rows of a batch, replacing target rows with the same key.

    Inside the batch the first row under ``order`` wins. The target side is only filtered, so it is shuffled once at
    most, and not at all while the batch is small enough for Catalyst to broadcast its keys.
    """
    fresh = dedupe_batch(batch, keys, order)
    return merge(target, fresh if loaded_at is None else stamp(fresh, "loaded_at", loaded_at), keys)


def merge(target: DataFrame, fresh: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is not in ``fresh``, and all of ``fresh``, whose keys are unique.

    A column that one side lacks is null there.
    """
    kept = target.join(fresh.select(*keys), list(keys), "left_anti")
    return kept.unionByName(fresh, allowMissingColumns=True)


def upsert_columns(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], update: Sequence[str], order: Sequence[Column],
    defaults: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Upsert that replaces only the columns in ``update`` of rows already there.

    New rows take every column the batch has; columns it lacks get their default or null.
    """
    defaults = defaults or {}
    fresh = dedupe_batch(batch, keys, order)
    old = target.withColumn("__old", F.lit(True)).alias("t")
    new = fresh.withColumn("__new", F.lit(True)).alias("b")
    joined = old.join(new, [F.col(f"t.{key}") == F.col(f"b.{key}") for key in keys], "full_outer")

    def pick(field) -> Column:
        name = field.name
        empty = defaults.get(name, F.lit(None)).cast(field.dataType)
        mine = F.col(f"t.{name}")
        theirs = F.col(f"b.{name}") if name in fresh.columns else empty
        if name in keys:
            return F.coalesce(mine, theirs).alias(name)
        if name in update:
            return F.when(F.col("__new"), theirs).otherwise(mine).alias(name)
        return F.when(F.col("__old"), mine).otherwise(F.coalesce(theirs, empty)).alias(name)

    return joined.select(*[pick(field) for field in target.schema.fields])


def update_where(
    target: DataFrame, changes: DataFrame, keys: Sequence[str], columns: Mapping[str, Column | str]
) -> DataFrame:
    """Set columns of the rows whose key occurs in ``changes``; other rows stay as they are.

    ``columns`` maps a target column to an expression over the columns of ``changes`` (or to one of their names). The
    keys in ``changes`` must be unique, see ``dedupe_batch``.
    """
    hits = changes.select(
        *keys,
        *[(F.col(value) if isinstance(value, str) else value).alias(f"__set_{name}") for name, value in columns.items()],
        F.lit(True).alias("__hit"),
    )
    joined = target.join(hits, list(keys), "left")
    return joined.select(*[
        F.when(F.col("__hit"), F.col(f"__set_{name}")).otherwise(F.col(name)).alias(name) if name in columns
        else F.col(name)
        for name in target.columns
    ])


def delete_keys(target: DataFrame, doomed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key does not occur in ``doomed``; rows without a key are never matched."""
    return target.join(doomed.select(*keys), list(keys), "left_anti")


def replace_slice(target: DataFrame, slice_rows: DataFrame, slice_keys: Sequence[str]) -> DataFrame:
    """Drop every row of the slices that occur in ``slice_rows`` and put those rows in their place."""
    return delete_keys(target, slice_rows.select(*slice_keys).distinct(), slice_keys).unionByName(slice_rows)


def add_missing_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add the columns (name to type) that are not there yet, filled with nulls."""
    return df.select("*", *[
        F.lit(None).cast(kind).alias(name) for name, kind in columns.items() if name not in df.columns
    ])
