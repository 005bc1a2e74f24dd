"""Exact-size pseudo-random selections of a table's keys without sorting the table."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.storagelevel import StorageLevel

#: Hex digits of the digests by which rows are counted, and those of the sums that come to the driver first.
CELL, GROUP = 4, 2


def key_digest(keys: Sequence[str], seed: int) -> Column:
    """md5 of the key and a seed: a random but repeatable order that other engines can compute too."""
    known = [F.col(key).cast("string") for key in keys]
    return F.md5(F.concat(*[part for text in known for part in (text, F.lit("|"))], F.lit(str(seed))))


def wanted_rows(total: int, fraction: float, rounding: str = "ceil", minimum: int = 0) -> int:
    """Selection size: the fraction rounded up or down, at least ``minimum``; nothing of an empty table."""
    if total == 0:
        return 0
    exact = total * fraction
    size = math.ceil(round(exact, 9)) if rounding == "ceil" else math.floor(round(exact, 9))
    return min(total, max(minimum, size))


@dataclass(frozen=True)
class Cut:
    """One selection: which share of the rows, in the order of which seed, rounded how, with how many rows at least."""

    fraction: float
    seed: int
    rounding: str = "ceil"
    minimum: int = 0


def _reached(rows: list, wanted: int) -> tuple[str, int, bool]:
    """Of (prefix, n) in order, the prefix in which the ``wanted``-th row lies, what is left to find in it, and whether the
    selection ends where the prefix does."""
    for prefix, n in sorted(rows):
        if n >= wanted:
            return prefix, wanted, n == wanted
        wanted -= n
    raise ValueError("fewer rows than wanted")


def select_fractions(df: DataFrame, keys: Sequence[str], cuts: Sequence[Cut]) -> list[Column]:
    """For each cut a predicate that holds for exactly the wanted share of the rows, those with the smallest key digests.

    Two passes over the keys serve all cuts. The first counts the rows of each cut by the first four digits of the digest
    (65,536 groups, merged in the map tasks); 512 sums a cut come to the driver and tell the group that holds the last
    selected row. The second looks at that group only, one row in 65,536, and is left out if every cut falls on a border.
    The answers are plain comparisons with a digest, so applying them moves no data. Keys should be unique: rows that share a
    key share its digest and are selected together. Rows without a key are never selected.
    """
    digests = F.array(*[F.struct(F.lit(i).alias("cut"), key_digest(keys, cut.seed).alias("digest")) for i, cut in enumerate(cuts)])
    exploded = df.select(F.explode(digests).alias("e")).select("e.cut", "e.digest").where("digest IS NOT NULL")
    cells = exploded.groupBy("cut", F.substring("digest", 1, CELL).alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    cells = cells.persist(StorageLevel.MEMORY_AND_DISK)

    def inside(column: str, prefixes: dict[int, str]) -> Column:
        found = F.lit(False)
        for i, prefix in prefixes.items():
            found = found | ((F.col("cut") == i) & F.col(column).startswith(prefix))
        return found

    def by_cut(rows: list, name: str) -> dict[int, list]:
        out: dict[int, list] = {}
        for row in rows:
            out.setdefault(row["cut"], []).append((row[name], row["n"]))
        return out

    try:
        groups = by_cut(cells.groupBy("cut", F.substring("cell", 1, GROUP).alias("part")).agg(F.sum("n").alias("n")).collect(), "part")
        left = {i: wanted_rows(sum(n for _, n in groups.get(i, ())), cut.fraction, cut.rounding, cut.minimum)
                for i, cut in enumerate(cuts)}
        ends = {i: _reached(groups[i], wanted) for i, wanted in left.items() if wanted}
        parts = by_cut(cells.where(inside("cell", {i: end[0] for i, end in ends.items()})).collect(), "cell") if ends else {}
        ends = {i: _reached(parts[i], end[1]) for i, end in ends.items()}
    finally:
        cells.unpersist()
    open_cuts = {i: end[0] for i, end in ends.items() if not end[2]}
    if open_cuts:
        needed = F.element_at(F.create_map(*[F.lit(x) for i in open_cuts for x in (i, ends[i][1])]), F.col("cut"))
        running = F.sum("n").over(Window.partitionBy("cut").orderBy("digest"))
        last = exploded.where(inside("digest", open_cuts)).groupBy("cut", "digest").agg(F.count(F.lit(1)).alias("n")).withColumn(
            "upto", running).where(F.col("upto") >= needed).groupBy("cut").agg(F.min("digest").alias("digest"))
        ends |= {row["cut"]: (row["digest"], 0, True) for row in last.collect()}
    return [
        F.coalesce(F.substring(key_digest(keys, cut.seed), 1, len(ends[i][0])) <= ends[i][0], F.lit(False)) if i in ends
        else F.lit(False) for i, cut in enumerate(cuts)]


def select_fraction(
    df: DataFrame, keys: Sequence[str], fraction: float, seed: int, rounding: str = "ceil", minimum: int = 0
) -> Column:
    """``select_fractions`` for one cut."""
    return select_fractions(df, keys, [Cut(fraction, seed, rounding, minimum)])[0]
