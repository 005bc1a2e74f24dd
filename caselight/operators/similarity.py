"""Nearest neighbours by cosine for unit vectors: sorted random-projection codes, exact scores inside a window.

Every vector gets one code per table, the signs of its products with random directions as bits. Vectors that point the same
way agree in most bits, so in the order of the codes they stand close together. In each table a vector is compared, by one
matrix product per block, with the rows of the blocks around it, and the best matches of all tables are merged. The work
grows with the number of vectors: each is shuffled once per table and compared with three blocks per table.

As long as a table fits into ``BLOCK_ROWS`` rows all its pairs are compared and the result is exact; beyond that it is
approximate, and ``tables`` and ``block_rows`` buy recall. A very common vector is no hot key: the order is cut anywhere,
also between equal codes, and equal vectors are equally good matches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from caselight.operators.latest import top_per_key

BLOCK_ROWS = 2048
TABLES = 8
REUSE_SCORE = 0.85
#: Bits of a code that come from directions; the low bits of the sort key spread equal codes.
CODE_BITS, SPREAD_BITS = 40, 22
#: Rows of one table that one task compares; sets the number of tasks, not what is compared.
TASK_ROWS = 65_536


def _coder(tables: int, seed: int):
    """Arrow function: add ``codes``, one sort key per table, to rows that end in ``spread`` and ``vector``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions = None
        weights = 1 << np.arange(CODE_BITS - 1, -1, -1, dtype=np.int64)
        for batch in batches:
            vectors = batch.column("vector")
            rows = batch.num_rows
            values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)
            if directions is None:
                directions = np.random.default_rng(seed).standard_normal((tables * CODE_BITS, values.shape[1]))
            bits = (values @ directions.T > 0).reshape(rows, tables, CODE_BITS)
            codes = (bits @ weights << SPREAD_BITS) + batch.column("spread").to_numpy()[:, None]
            listed = pa.ListArray.from_arrays(pa.array(np.arange(rows + 1) * tables, pa.int32()), pa.array(codes.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, listed], [*batch.schema.names, "codes"])

    return run


class _Block:
    """Some consecutive rows of a table: which of them ask, which may be found, and their vectors."""

    def __init__(self, batch: pa.RecordBatch):
        vectors = batch.column("vector")
        self.vectors = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1)
        self.queries, self.corpus, self.rank = batch.column("q_id"), batch.column("c_id"), batch.column("rank").to_numpy()
        self.asks = np.flatnonzero(batch.column("asks").to_numpy(zero_copy_only=False))
        self.found = np.flatnonzero(batch.column("found").to_numpy(zero_copy_only=False))


def _best(block: _Block, around: list[_Block], k: int, ordered: bool, min_score: float | None) -> pa.RecordBatch:
    """The ``k`` best matches of each asking row of a block among the rows of the blocks around it."""
    ids = pa.concat_arrays([b.corpus.take(pa.array(b.found)) for b in around])
    place = np.empty(len(ids), np.int64)
    place[pc.sort_indices(ids).to_numpy()] = np.arange(len(ids))  # ties go to the smaller id
    scores = np.round(block.vectors[block.asks] @ np.concatenate([b.vectors[b.found] for b in around]).T, 12)
    if ordered:
        rank = np.concatenate([b.rank[b.found] for b in around])
        scores[rank[None, :] >= block.rank[block.asks][:, None]] = -np.inf
    wanted = scores > -np.inf if min_score is None else scores >= min_score
    if len(ids) > k:
        wanted &= scores >= np.partition(scores, len(ids) - k, axis=1)[:, [len(ids) - k]]
    near, match = np.nonzero(wanted)
    best = np.lexsort((place[match], -scores[near, match], near))
    near, match = near[best], match[best]
    position = np.arange(len(near)) - np.searchsorted(near, near)  # rank among the matches of one row
    near, match = near[position < k], match[position < k]
    return pa.RecordBatch.from_arrays(
        [block.queries.take(pa.array(block.asks[near])), ids.take(pa.array(match)), pa.array(scores[near, match])],
        ["query_id", "match_id", "score"])


def _windows(k: int, ordered: bool, min_score: float | None, block_rows: int):
    """Arrow function over rows in the order of table and code: compare each block with itself and its neighbours."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, _Block]]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            numbers = batch.column("table").to_numpy()
            starts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
            for start, end in zip(starts, starts[1:]):
                while start < end:
                    if held and held[0].column("table")[0].as_py() != numbers[start]:
                        yield packed(held)
                        held = []
                    room = block_rows - sum(part.num_rows for part in held)
                    held.append(batch.slice(start, min(room, end - start)))
                    start += held[-1].num_rows
                    if sum(part.num_rows for part in held) == block_rows:
                        yield packed(held)
                        held = []
        if held:
            yield packed(held)

    def packed(parts: list[pa.RecordBatch]) -> tuple[int, _Block]:
        whole = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        return whole.column("table")[0].as_py(), _Block(whole)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = here = None
        for after in _with_end(blocks(batches)):
            if here is not None and len(here[1].asks):
                around = [one[1] for one in (before, here, after) if one is not None and one[0] == here[0]]
                if sum(len(one.found) for one in around):
                    yield _best(here[1], around, k, ordered, min_score)
            before, here = here, after

    return run


def _with_end(items: Iterator) -> Iterator:
    yield from items
    yield None


def nearest(
    queries: DataFrame, corpus: DataFrame, k: int, *, query_key: str = "query_id", corpus_key: str = "incident_id",
    vector: str = "vector", order: str | None = None, min_score: float | None = None, tables: int = TABLES,
    block_rows: int = BLOCK_ROWS, seed: int = 11,
) -> DataFrame:
    """The ``k`` most similar corpus rows of each query: (query_id, match_id, score, rank); ties go to the smaller id.

    Keys are unique on their side and of any type that sorts, text too. ``order`` names a numeric column of both sides;
    with it a query only sees corpus rows that come strictly before it. Rows without a vector are left out; all vectors
    have the same length. Exact up to ``block_rows`` rows on both sides together, see above for more.
    """
    same = corpus is queries

    def side(df: DataFrame, query: Column, found: Column, asks: bool, is_found: bool) -> DataFrame:
        rank = F.col(order).cast("bigint") if order else F.lit(0).cast("bigint")
        return df.where(F.col(vector).isNotNull()).select(
            query.alias("q_id"), found.alias("c_id"), F.coalesce(rank, F.lit(0)).alias("rank"), F.lit(asks).alias("asks"),
            F.lit(is_found).alias("found"), F.col(vector).alias("vector"))

    q_type, c_type = queries.schema[query_key].dataType, corpus.schema[corpus_key].dataType
    if same:
        rows = side(queries, F.col(query_key), F.col(corpus_key), True, True)
    else:
        rows = side(queries, F.col(query_key), F.lit(None).cast(c_type), True, False).unionByName(
            side(corpus, F.lit(None).cast(q_type), F.col(corpus_key), False, True))
    rows = rows.withColumn("spread", F.pmod(F.xxhash64("q_id", "c_id"), F.lit(1 << SPREAD_BITS)))
    kind = rows.schema["vector"].dataType.simpleString()
    fields = f"q_id {q_type.simpleString()}, c_id {c_type.simpleString()}, rank bigint, asks boolean, found boolean"
    coded = rows.mapInArrow(_coder(tables, seed), f"{fields}, vector {kind}, spread bigint, codes array<bigint>")
    spread = coded.select("q_id", "c_id", "rank", "asks", "found", "vector", F.posexplode("codes").alias("table", "code"))
    tasks = -(-rows.count() // TASK_ROWS)
    # One task holds whole tables while they are small, so that no border falls inside them.
    placed = spread.repartitionByRange(tasks * tables, "table", "code") if tasks > 1 else spread.repartition("table")
    matches = placed.sortWithinPartitions("table", "code").mapInArrow(
        _windows(k, order is not None, min_score, block_rows),
        f"query_id {q_type.simpleString()}, match_id {c_type.simpleString()}, score double")
    merged = matches.repartition("query_id").groupBy("query_id", "match_id").agg(F.max("score").alias("score"))
    return top_per_key(merged, ["query_id"], [F.desc("score"), F.asc("match_id")], k)


def reusable_fixes(queries: DataFrame, incidents: DataFrame, min_score: float = REUSE_SCORE, **options) -> DataFrame:
    """For each query the most similar earlier incident whose SQL fix worked, if it is similar enough."""
    return nearest(queries, incidents.where("has_sql_fix"), 1, min_score=min_score, **options).drop("rank")


def unit(vector: Column) -> Column:
    """A vector scaled to length one."""
    length = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")))
    return F.when(length > 0, F.transform(vector, lambda x: x.cast("double") / length))
