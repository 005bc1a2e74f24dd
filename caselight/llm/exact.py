"""Exact duplicates by progressive refinement: length, then prefix hash, then full digest. DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from caselight.llm.common import SPACE, attach, stored

PREFIX = 64


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after deleting white space; null counts as empty. Of equal texts the row with the most
    code points stays, then the smallest id (null last). Rows that repeat the id of the row that stays are kept as well:
    they are the same document. An empty table gives no rows; other columns are not read.

    One scan turns each text into five small values. Only lengths that occur more than once reach the comparison of
    prefixes, only prefixes that occur more than once that of digests. Each grouping merges counts in the map tasks, so a
    length or text that a third of all rows shares costs one row per task. The last join is on a table written before
    it, so that Spark splits the rows of a frequent text over many tasks.
    """
    rows, groups = refined(docs, id_col, text_col)
    joined = rows.join(groups, ["len", "digest"], "left")
    grouped = F.col("group_size").isNotNull()
    keep = F.when(grouped, F.col("keep_id")).otherwise(F.col("id"))
    return joined.select(
        F.col("id").alias(id_col), keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias(
            "group_size"), F.col("id").eqNullSafe(keep).alias("kept"), F.col("digest").alias("text_sha256"))


def bare_text(text: Column) -> Column:
    """The text without white space; empty for null."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE + "+", "")


def refined(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Stored: one narrow row per input row, and the groups of two rows or more with the id that stays."""
    rows = stored(docs.select(
        F.col(id_col).alias("id"), F.length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("points"),
        bare_text(F.col(text_col)).alias("bare")).select(
        "id", "points", F.length("bare").cast("long").alias("len"),
        F.xxhash64(F.substring("bare", 1, PREFIX)).alias("prefix"), F.sha2(F.col("bare"), 256).alias("digest")), "exact")
    lengths = rows.groupBy("len").agg(F.count("*").alias("n")).filter("n > 1").select("len")
    prefixes = (rows.groupBy("len", "prefix").agg(F.count("*").alias("n")).filter("n > 1").select("len", "prefix")
                .join(lengths, "len", "left_semi"))
    prefixes = stored(prefixes, "exact_prefixes")
    full = rows.join(prefixes, ["len", "prefix"], "left_semi").groupBy("len", "prefix", "digest").agg(
        F.count("*").alias("group_size"),
        F.min(F.struct((-F.col("points")).alias("points"), F.col("id").isNull().alias("no_id"), "id")).alias("best"))
    groups = stored(full.filter("group_size > 1").select("len", "digest", "group_size", F.col("best.id").alias("keep_id")),
                    "exact_groups")
    return rows, groups


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``exact_groups`` keeps, with all their columns.

    Of rows that repeat the id that stays, the one with most code points stays, then the one with the smaller hash of all its
    columns: the same in every run. An empty table gives none; columns of any name come back as they were.
    """
    _, groups = refined(docs, id_col, text_col)
    side = stored(groups.select("digest", "keep_id", F.lit(True).alias("grouped")), "copies")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    marked = docs.select(whole.alias("row"), F.sha2(bare_text(F.col(text_col)), 256).alias("digest"), F.col(id_col).alias("id"),
                         F.length(F.coalesce(F.col(text_col), F.lit(""))).alias("points"))
    joined = attach(marked, side, "digest", "left", F.lit(100))
    alone = joined.filter(F.col("grouped").isNull()).select("row")
    order = F.struct(-F.col("points"), F.xxhash64("row"), F.xxhash64(F.lit(1), "row"))
    firsts = joined.filter(F.col("grouped") & F.col("id").eqNullSafe(F.col("keep_id"))).groupBy("digest").agg(
        F.min_by("row", order).alias("row")).select("row")
    return alone.unionByName(firsts).select("row.*")
