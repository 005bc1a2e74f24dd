"""Quality and volume checks on every micro-batch."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from caselight.operators import monitors, quality
from caselight.operators.changes import with_key
from caselight.sources.tables import KeyedTable, put
from caselight.streaming.jobs import start_batches


def start_checks(
    rows: DataFrame, rules: Iterable[quality.Rule], baselines: DataFrame, schema: str, table: str, at, output: str,
    checkpoint: str, every: str | None = None, seen: KeyedTable | None = None,
) -> StreamingQuery:
    """Append a rule report and the row-count check of each micro-batch to ``output``.

    Rows are written per batch, so a batch that is handed over again replaces its first copy. ``baselines`` have the
    scope of a batch: like is compared with like. With ``seen``, a keyed table that remembers the keys of all batches, keys
    that come again in a later batch are reported as well, see ``repeated_keys``.
    """
    rules = list(rules)

    def check(batch: DataFrame, batch_id: int) -> None:
        report = quality.run_rules(batch, rules, table)
        put(report.withColumn("batch_id", F.lit(batch_id)), f"{output}/rules", str(batch_id))
        counts = batch.agg(F.count(F.lit(1)).alias("current_count")).select(
            F.lit(schema).alias("schema_name"), F.lit(table).alias("table_name"), "current_count")
        alerts = monitors.count_alerts(monitors.count_check(counts, baselines, scope="batch"), at)
        put(alerts.withColumn("batch_id", F.lit(batch_id)), f"{output}/alerts", str(batch_id))
        if seen is not None:
            put(repeated_keys(batch, batch_id, seen).withColumn("batch_id", F.lit(batch_id)), f"{output}/repeated", str(batch_id))
            remember_keys(batch, batch_id, seen)

    return start_batches(rows, check, checkpoint, every)


def repeated_keys(batch: DataFrame, batch_id: int, seen: KeyedTable) -> DataFrame:
    """(keys, n_rows, first_batch) of the keys that occur twice in this batch or came in an earlier one.

    ``seen`` has the keys and ``first_batch``. Only the buckets that the keys of the batch fall into are read. Keys that this
    batch itself left there when it was handed over before do not count as earlier ones; rows without a key are left out.
    """
    keys = list(seen.keys)
    counted = with_key(batch, keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    known = seen.lookup(batch)
    if known is None:
        joined = counted.withColumn("first_batch", F.lit(batch_id).cast("bigint"))
    else:
        joined = counted.join(known.select(*keys, "first_batch"), keys, "left").withColumn(
            "first_batch", F.coalesce("first_batch", F.lit(batch_id).cast("bigint")))
    return joined.where((F.col("n_rows") > 1) | (F.col("first_batch") != batch_id))


def remember_keys(batch: DataFrame, batch_id: int, seen: KeyedTable) -> None:
    """Add the keys of a batch that were not there before; doing it again changes nothing."""
    keys = list(seen.keys)
    fresh = with_key(batch.select(*keys), keys).distinct()
    known = seen.lookup(fresh)
    if known is not None:
        fresh = fresh.join(known.select(*keys), keys, "left_anti")
    seen.upsert(fresh.withColumn("first_batch", F.lit(batch_id).cast("bigint")), [F.asc("first_batch")])
