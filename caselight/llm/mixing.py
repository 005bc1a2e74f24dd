"""Mixing sources to target weights with Sainte-Laguë apportionment of equal blocks of words.

Seats are blocks. Sources get seats by their targets, the shards of a source by their words, both by highest quotients
``weight / (2 * seats + 1)``. Within a shard the documents stand in a seeded order on a line of words; the line is cut
into blocks and a seeded, evenly spaced choice of blocks fills the quota.
"""

from __future__ import annotations

import heapq
from fractions import Fraction

import pandas as pd
from pyspark.sql import DataFrame, functions as F, Window

from caselight.llm.common import attach, stored, wide_key, word_count, wrapped

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)


def sainte_lague(weights: list[Fraction | int], seats: int) -> list[int]:
    """Seats by highest quotients; ties go to the earlier party. Parties of weight 0 get none.

    Rounding at the mean divisor lands within half a seat for each party; the few steps left are taken by quotients.
    """
    total = sum(weights)
    if not total or seats <= 0:
        return [0] * len(weights)
    got = [int((2 * w * seats + total) // (2 * total)) for w in weights]
    odd = seats - sum(got)
    if odd > 0:
        heap = [(-Fraction(w) / (2 * s + 1), i) for i, (w, s) in enumerate(zip(weights, got)) if w]
        heapq.heapify(heap)
        for _ in range(odd):
            i = heap[0][1]
            got[i] += 1
            heapq.heapreplace(heap, (-Fraction(weights[i]) / (2 * got[i] + 1), i))
    elif odd < 0:
        heap = [(Fraction(w) / (2 * s - 1), -i) for i, (w, s) in enumerate(zip(weights, got)) if s]
        heapq.heapify(heap)
        for _ in range(-odd):
            i = -heapq.heappop(heap)[1]
            got[i] -= 1
            if got[i]:
                heapq.heappush(heap, (Fraction(weights[i]) / (2 * got[i] - 1), -i))
    return got


def targets(sizes: list[int], weights: list[int], cap: int) -> list[Fraction]:
    """Shares of all words by weight; a target stops at ``cap`` times its size and the excess is shared again."""
    left, open_weight = Fraction(sum(sizes)), sum(w for w, s in zip(weights, sizes))
    out = [Fraction(0)] * len(sizes)
    order = sorted(range(len(sizes)), key=lambda i: Fraction(cap * sizes[i], weights[i]))
    for i in order:  # those that reach their cap first come first
        share = left * weights[i] / open_weight
        out[i] = min(share, Fraction(cap * sizes[i]))
        left -= out[i]
        open_weight -= weights[i]
    return out


def plan_sources(rows: pd.DataFrame, block_words: int, cap: int, shard_words: int) -> pd.DataFrame:
    names = [None if pd.isna(s) else s for s in rows["source"]]
    order = sorted(range(len(names)), key=lambda i: (names[i] is None, names[i] or ""))
    sizes = [int(rows["source_size"].iloc[i]) for i in order]
    goal = targets(sizes, [WEIGHTS[i % len(WEIGHTS)] for i in range(len(order))], cap)
    quota = sainte_lague(goal, round(Fraction(sum(sizes), block_words)))
    return pd.DataFrame({"source": pd.Series([names[i] for i in order], dtype=object), "source_size": sizes,
                         "target": [float(g) for g in goal], "quota": quota,
                         "shards": [max(1, -(-s // shard_words)) for s in sizes]})


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        block_words: int = 16, shard_words: int = 2_000_000, cap: int = 3, seed: int = 7) -> DataFrame:
    """One row per input row: id, size, source_size, target, taken (words that the mix takes, repeats counted).

    ``target`` is that of the source. A null source is a source of its own, after all others; null text has no words and
    nothing is taken of it. Repeated rows are placed one by one. The plan over sources handles one row per source; rows
    are dealt by source and shard, so a source with a third of all rows spreads over many shards.
    """
    chosen = _placed(docs, id_col, text_col, source_col, block_words, shard_words, cap, seed)

    def upto(x: str) -> str:
        """Words of the chosen blocks that lie before word ``x`` of the line."""
        k = f"(({x}) div {block_words})"
        before, after = f"(({k} * extra + start) div n)", f"((({k} + 1) * extra + start) div n)"
        return f"({block_words} * {before} + ({after} - {before}) * (({x}) - {block_words} * {k}))"

    return chosen.select(
        F.col("id").alias(id_col), "size", "source_size", "target",
        F.expr(f"least({cap} * size, passes * size + {upto('at + size')} - {upto('at')})").cast("long").alias("taken"))


def take_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                   block_words: int = 64, shard_words: int = 2_000_000, cap: int = 3, seed: int = 7) -> DataFrame:
    """The mix in whole documents, with all their columns: a document is repeated once for each full pass over its shard
    and once more if its first word lies in a chosen block. Documents without words are left out. Rows that repeat id and
    text are taken as often as the one of them that is taken most often.
    """
    chosen = _placed(docs, id_col, text_col, source_col, block_words, shard_words, cap, seed)
    block = f"(at div {block_words})"
    extra_copy = f"((({block} + 1) * extra + start) div n) - (({block} * extra + start) div n)"
    copies = chosen.filter("size > 0").select("key", F.expr(f"least({cap}, passes + {extra_copy})").alias("copies"))
    per_key = stored(copies.groupBy("key").agg(F.max("copies").alias("copies")), "copies")
    joined = attach(wrapped(docs, id_col, text_col), per_key.filter("copies > 0"), "key", "inner")
    return joined.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")


def _placed(docs: DataFrame, id_col: str, text_col: str, source_col: str, block_words: int, shard_words: int, cap: int,
            seed: int) -> DataFrame:
    """Rows on the lines of their shards, with the full passes, extra blocks and seeded start of each shard."""
    size = word_count(F.col(text_col))
    key = wide_key(F.col(id_col), F.col(text_col))
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size"), key.alias("key")).select(
        "*", F.xxhash64(F.lit(seed), F.col("key")).alias("place"))
    rows = stored(rows, "mix")
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = sums.groupBy().applyInPandas(
        lambda part: plan_sources(part, block_words, cap, shard_words),
        "source string, source_size long, target double, quota long, shards long")
    plan = stored(plan, "mix_sources")
    dealt = rows.join(plan, rows["source"].eqNullSafe(plan["source"])).select(
        "id", rows["source"], "size", "key", "place", "source_size", "target", "quota",
        F.expr("pmod(xxhash64(place), shards)").alias("shard"))

    def shard_quotas(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("shard", ignore_index=True)
        got = sainte_lague([int(x) for x in part["line"]], int(part["quota"].iloc[0]) if len(part) else 0)
        return part.assign(blocks=got)[["source", "shard", "line", "blocks"]]

    lines = dealt.groupBy("source", "shard").agg(F.sum("size").alias("line"), F.max("quota").alias("quota"))
    quotas = lines.groupBy("source").applyInPandas(
        shard_quotas, "source string, shard long, line long, blocks long").alias("q")
    rank = Window.partitionBy("source", "shard").orderBy("place", "key", "id").rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("at", F.coalesce(F.sum("size").over(rank), F.lit(0))).alias("d")
    joined = placed.join(quotas, F.col("d.source").eqNullSafe(F.col("q.source"))
                         & (F.col("d.shard") == F.col("q.shard"))).select("d.*", "q.line", "q.blocks")
    return joined.select(
        "*", F.expr(f"least(blocks * {block_words}, {cap} * line)").alias("goal"),
        F.expr(f"greatest(1, (line + {block_words} - 1) div {block_words})").alias("n")).select(
        "*", F.expr("if(line > 0, goal div line, 0)").alias("passes"),
        F.expr(f"if(line > 0, least(n, ((goal % line) + {block_words} div 2) div {block_words}), 0)").alias("extra"),
        F.expr(f"pmod(xxhash64({seed}, source, shard), n)").alias("start"))
