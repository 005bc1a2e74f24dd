"""URL filters: a sorted sweep over reversed host names joins urls with nested prefix rules.

A host becomes a key of its labels in reverse, each closed by a dot (``a.example.net`` -> ``net.example.a.``). A host and
all its subdomains are then one interval of keys, and the intervals of rules nest like brackets. Urls and rules are cut
into blocks along the key order; a rule goes to each block that its interval meets. Within a block one pass over the
sorted rows keeps a stack of the rule hosts that enclose the current url.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from caselight.llm.common import partitions

#: Keys that are drawn for each block to place its borders. Borders only balance the blocks, they never change a result.
KEYS_PER_BLOCK = 20
MAX_BLOCKS = 20_000
ROWS_PER_BLOCK = 200_000


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/ ? #``, with A-Z lower-cased; empty for null or a url without scheme."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def judge_urls(urls: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
               default: str = "allow") -> DataFrame:
    """Verdict of each url: the longest fitting rule decides, else ``default``.

    ``rules`` has the columns host, path and verdict. A rule fits its host and all subdomains if the path of the url
    starts with the path of the rule. Of fitting rules the one with the longest ``host + path`` wins, then the longer
    host, then ``block``. Returns the id, host, path, rule (null if none fits) and verdict, one row for each input row.
    Null urls and urls without ``://`` have an empty host and path. Rules with a null host, path or verdict are ignored;
    repeated rules count once. Other columns of either table are not read.
    """
    spark = urls.sparkSession
    kind = urls.schema[id_col].dataType
    probes = urls.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"),
                         path_of(F.col(url_col)).alias("path"))
    probes = probes.withColumn("key", host_key(F.col("host"))).withColumn("salt", F.xxhash64("id", "path"))
    total = probes.count()
    blocks = min(MAX_BLOCKS, max(4 * partitions(spark), total // ROWS_PER_BLOCK + 1))
    # A bounded set of keys, chosen by hash, gives the borders. A hot host has many borders, told apart by the salt.
    drawn = (probes.select("key", "salt").orderBy(F.xxhash64("salt"), "key").limit(KEYS_PER_BLOCK * blocks).collect()
             if blocks > 1 else [])
    drawn = sorted((r["key"], r["salt"]) for r in drawn)
    borders = sorted({drawn[len(drawn) * i // blocks] for i in range(1, blocks)}) if drawn else []

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, salts = batch.column("key").to_pylist(), batch.column("salt").to_pylist()
            at = [bisect_right(borders, pair) for pair in zip(keys, salts)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int32())], [*batch.schema.names, "block"])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = -(1 << 63), (1 << 63) - 1
        for batch in batches:
            for row in batch.to_pylist():
                first = bisect_left(borders, (row["key"], low))
                last = bisect_right(borders, (row["key"][:-1] + "/", high))
                n = last - first + 1
                yield pa.RecordBatch.from_pydict(
                    {name: pa.array([row[name]] * n, batch.schema.field(name).type) for name in batch.schema.names}
                    | {"block": pa.array(range(first, last + 1), pa.int32())})

    block_type = T.StructField("block", T.IntegerType())
    placed = probes.mapInArrow(place, T.StructType([*probes.schema.fields, block_type]))
    intervals = rules.select("host", "path", "verdict").dropna().distinct().withColumn("key", host_key(F.col("host")))
    intervals = intervals.mapInArrow(spread, T.StructType([*intervals.schema.fields, block_type]))
    none = F.lit(None)
    events = placed.select("block", "key", F.lit(1).alias("is_url"), "id", "host", "path", none.cast("string").alias(
        "verdict")).unionByName(intervals.select("block", "key", F.lit(0).alias("is_url"), none.cast(kind).alias("id"),
                                                 "host", "path", "verdict"))
    ordered = events.repartition("block").sortWithinPartitions("block", "key", "is_url")

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, stack = None, []  # of (key, host, {path: verdict}, lengths of these paths in descending order)
        for batch in batches:
            ids, hosts, paths, found, verdicts = [], [], [], [], []
            for row_block, key, is_url, row_id, host, path, verdict in zip(*(c.to_pylist() for c in batch.columns)):
                if row_block != block:
                    block, stack = row_block, []
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if not is_url:
                    if not stack or stack[-1][0] != key:
                        stack.append((key, host, {}, []))
                    known = stack[-1][2]
                    if known.get(path) != "block":
                        known[path] = verdict
                    stack[-1][3][:] = sorted({len(p) for p in known}, reverse=True)
                    continue
                best, rule, judged = -1, None, default
                for _, rule_host, known, lengths in reversed(stack):  # the longer host first, so that it wins ties
                    for n in lengths:
                        if n <= len(path) and len(rule_host) + n > best and path[:n] in known:
                            best, rule, judged = len(rule_host) + n, rule_host + path[:n], known[path[:n]]
                            break
                for column, value in zip((ids, hosts, paths, found, verdicts), (row_id, host, path, rule, judged)):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, batch.schema.field("id").type), *(pa.array(c, pa.string()) for c in (
                    hosts, paths, found, verdicts))], [id_col, "host", "path", "rule", "verdict"])

    ordered = ordered.select("block", "key", "is_url", "id", "host", "path", "verdict")
    return ordered.mapInArrow(sweep, f"`{id_col}` {kind.simpleString()}, host string, path string, rule string, "
                                     "verdict string")
