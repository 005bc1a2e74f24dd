"""Aggregates over staged reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

MIN_REPORTS = 5
REACTION_INPUTS = ["report_id", "drug_name", "reaction", "is_serious", "is_fatal", "patient_age", "received_date"]
SERIOUS_INPUTS = ["report_id", "drug_name", "outcome", "is_serious", "is_fatal", "patient_age", "received_date"]


def report_groups(staged: DataFrame) -> DataFrame:
    """Counts and sums by drug, reaction, outcome and seriousness: all that both marts need, from one scan.

    Reports are merged per map task before the shuffle, so a drug with a third of all reports costs no more than others.
    """
    return staged.groupBy("drug_name", "reaction", "outcome", "is_serious").agg(
        F.count(F.lit(1)).alias("reports"),
        F.count_if("is_fatal").alias("fatal"),
        F.sum("patient_age").alias("age_sum"),
        F.count("patient_age").alias("age_count"),
        F.max("received_date").alias("newest"),
    )


GROUP = ["drug_name", "reaction", "outcome", "is_serious"]


def changed_groups(groups: DataFrame, removed: DataFrame | None, added: DataFrame | None) -> DataFrame:
    """``report_groups`` after some staged rows went and others came, without a look at the rows that stayed.

    Counts and sums are added up; rows that are in both ``removed`` and ``added`` cancel. A newest date can only be lost
    with a removed row; where that may be, ``lost`` is true and ``newest`` has to be looked up, see ``with_newest``.
    """
    numbers = ["reports", "fatal", "age_sum", "age_count"]
    none = F.lit(None).cast("date")

    def part(df: DataFrame, sign: int, name: str) -> DataFrame:
        dates = [(F.col("newest") if name == column else none).alias(column) for column in ("before", "gone", "come")]
        return df.select(*GROUP, *[(F.lit(sign) * F.col(n)).cast(kinds[n]).alias(n) for n in numbers], *dates)

    kinds = {field.name: field.dataType for field in groups.schema.fields}
    rows = part(groups, 1, "before")
    for staged, sign, name in ((removed, -1, "gone"), (added, 1, "come")):
        if staged is not None:
            rows = rows.unionByName(part(report_groups(staged), sign, name))
    summed = rows.groupBy(*GROUP).agg(
        *[F.sum(n).cast(kinds[n]).alias(n) for n in numbers], *[F.max(n).alias(n) for n in ("before", "gone", "come")])
    lost = (F.col("gone") == F.col("before")) & (F.coalesce(F.col("come") < F.col("gone"), F.lit(True)))
    return summed.where("reports > 0").select(
        *GROUP, *numbers, F.greatest("before", "come").alias("newest"), F.coalesce(lost, F.lit(False)).alias("lost"))


def with_newest(changed: DataFrame, staged: DataFrame) -> DataFrame:
    """Fill in the newest dates that ``changed_groups`` could not tell, from the rows of those groups."""
    lost = changed.where("lost").select(*GROUP)
    same = F.lit(True)
    for name in GROUP:
        same = same & staged[name].eqNullSafe(lost[name])
    found = staged.join(lost, same, "left_semi").groupBy(*GROUP).agg(F.max("received_date").alias("newest"))
    kept = changed.where("NOT lost").drop("lost")
    numbers = [name for name in kept.columns if name not in (*GROUP, "newest")]
    empty = [F.lit(None).cast(kept.schema[name].dataType).alias(name) for name in numbers]
    filled = changed.where("lost").drop("lost").withColumn("newest", F.lit(None).cast("date")).unionByName(
        found.select(*GROUP, *empty, "newest")).groupBy(*GROUP).agg(
        *[F.max(name).alias(name) for name in numbers], F.max("newest").alias("newest"))
    return kept.unionByName(filled)


def _mean_age(total: Column, known: Column) -> Column:
    """Mean rounded to one digit; the decimal sum is exact and divided only once."""
    return F.when(known > 0, F.round(total.cast("double") / known, 1))


def drug_reactions(staged: DataFrame) -> DataFrame:
    """Report volume of each drug and reaction. A stored table has no row order, so none is imposed."""
    return staged.groupBy("drug_name", "reaction").agg(
        F.count(F.lit(1)).alias("report_count"),
        F.count_if("is_serious").alias("serious_count"),
        F.count_if("is_fatal").alias("fatal_count"),
        _mean_age(F.sum("patient_age"), F.count("patient_age")).alias("avg_patient_age"),
        F.max("received_date").alias("most_recent_report_date"),
    )


def drug_reactions_from_groups(groups: DataFrame) -> DataFrame:
    """The same from ``report_groups``."""
    return groups.groupBy("drug_name", "reaction").agg(
        F.sum("reports").alias("report_count"),
        F.sum(F.when(F.col("is_serious"), F.col("reports")).otherwise(0)).alias("serious_count"),
        F.sum("fatal").alias("fatal_count"),
        _mean_age(F.sum("age_sum"), F.sum("age_count")).alias("avg_patient_age"),
        F.max("newest").alias("most_recent_report_date"),
    )


def serious_events(staged: DataFrame, min_reports: int = MIN_REPORTS) -> DataFrame:
    """Serious reports by drug and outcome, ranked inside each drug, pairs with more than ``min_reports`` only."""
    pairs = staged.where("is_serious").groupBy("drug_name", "outcome").agg(
        F.count(F.lit(1)).alias("report_count"),
        F.count_if("is_fatal").alias("fatal_count"),
        _mean_age(F.sum("patient_age"), F.count("patient_age")).alias("avg_patient_age"),
        F.max("received_date").alias("most_recent_date"),
    )
    return _ranked(pairs, min_reports)


def serious_events_from_groups(groups: DataFrame, min_reports: int = MIN_REPORTS) -> DataFrame:
    """The same from ``report_groups``."""
    pairs = groups.where("is_serious").groupBy("drug_name", "outcome").agg(
        F.sum("reports").alias("report_count"),
        F.sum("fatal").alias("fatal_count"),
        _mean_age(F.sum("age_sum"), F.sum("age_count")).alias("avg_patient_age"),
        F.max("newest").alias("most_recent_date"),
    )
    return _ranked(pairs, min_reports)


def _ranked(pairs: DataFrame, min_reports: int) -> DataFrame:
    """Keep the pairs with enough reports and rank them inside their drug.

    The filter comes before the window: a rank counts the pairs with more reports, so the pairs filtered out, which have
    fewer, change no rank. What a window task sorts is one row per outcome code of its drugs, not their reports.
    """
    by_volume = Window.partitionBy("drug_name").orderBy(F.desc("report_count"))
    return pairs.where(F.col("report_count") > min_reports).withColumn("severity_rank", F.rank().over(by_volume))
