"""Connected components of a table of links, by turns of large stars and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from caselight.llm.common import stored


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """Columns node and label for each node of ``links`` (columns a and b); the label is the least node of its component.

    Each round hangs every node below the least neighbour it knows, first for larger neighbours, then for smaller ones,
    until the stars no longer change. The rounds grow with the logarithm of the number of nodes. Each is written to the
    shared folder. Minima merge in the map tasks, so a node with very many links is no large group.
    """
    def star(edges: DataFrame, name: str) -> DataFrame:
        return stored(edges.filter("a <> b").distinct(), name)

    edges = star(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "links")
    seen = None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), "least")
        large = star(both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")), "large")
        least = stored(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(least, "a")
        edges = star(small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))), "small")
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError("the components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
