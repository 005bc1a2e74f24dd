"""Brings equal windows of a corpus together without pairing documents.

A window is a run of ``length`` items (bytes or words) of one document. Its anchor is the gram of least hash in it, the
leftmost if several are least: equal windows have equal anchors at equal places. Consecutive windows with the same anchor
form a segment, and all segments of one anchor go to one shard, so a shard sees every copy of each of its windows and can
index them alone. Anchors that occur once in the corpus are dropped before any text moves: their windows occur once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from caselight.llm import hashing as H
from caselight.llm.common import keyed, partitions, stored

#: Bits of an anchor's hash that order grams; the rest of a 64-bit key holds the place within a block.
_PLACE_BITS = 24
_BLOCK = 1 << 22
ANCHORS_PER_SHARD = 1_000_000
BYTES_PER_SHARD = 1_000_000
#: Bytes of text that a worker hashes at once; some dozen arrays of eight bytes a byte of text stand beside them.
BYTES_AT_ONCE = 1_500_000


@dataclass(frozen=True)
class Unit:
    """``words`` tells whether items are words; else they are bytes."""

    words: bool
    length: int
    gram: int


def items_of(column: pa.Array, unit: Unit):
    """Data, gram hashes, where the items of each text start and end, and the byte span of each item (words only)."""
    data, at = H.flat(column)
    if unit.words:
        starts, ends, bounds = H.word_spans(data, at)
        return data, H.gram_hashes(H.word_hashes(data, starts, ends), unit.gram), bounds, starts, ends
    return data, _byte_grams(data, unit.gram), at, None, None


def _byte_grams(data: np.ndarray, n: int) -> np.ndarray:
    if len(data) < n:
        return np.zeros(0, np.uint64)
    run = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(H._LETTER[data] * H.powers(H._BASE, len(data)), out=run[1:])
    gram = run[n:] - run[:-n]
    gram *= H.powers(H._UNBASE, len(gram))
    gram ^= gram >> np.uint64(29)
    gram *= np.uint64(0xBF58476D1CE4E5B9)
    gram ^= gram >> np.uint64(32)
    return gram


def cut(grams: np.ndarray, bounds: np.ndarray, unit: Unit):
    """Segments of all texts: text, first and last window start, anchor place (all within the batch), anchor hash."""
    span = unit.length - unit.gram + 1
    n = max(len(grams) - span + 1, 0)
    anchors = np.empty(n, np.int64)
    low = np.uint64((1 << _PLACE_BITS) - 1)
    for a in range(0, n, _BLOCK):
        b = min(n, a + _BLOCK)
        least = grams[a:b + span - 1] & ~low
        least |= np.arange(len(least), dtype=np.uint64)
        width = 1
        while width * 2 <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < span:
            least = np.minimum(least[:len(least) - (span - width)], least[span - width:])
        anchors[a:b] = (least & low).astype(np.int64) + a
    counts = np.maximum(np.diff(bounds) - unit.length + 1, 0)
    total = int(counts.sum())
    if not total:
        none = np.zeros(0, np.int64)
        return none, none, none, none, np.zeros(0, np.uint64)
    text = np.repeat(np.arange(len(counts)), counts)
    start = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(bounds[:-1], counts)
    anchor = anchors[start]
    new = np.ones(total, bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], total) - 1
    return text[first], start[first], start[last], anchor[first], grams[anchor[first]]


def rows_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, text (null as empty) and the key of each row."""
    return keyed(docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")),
                 "id", "text", "key")


def repeated_anchors(docs: DataFrame, unit: Unit) -> DataFrame:
    """For each document with anchors that occur more than once: key and their places (packed, 4 bytes each)."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    density = (unit.length - unit.gram + 2) / 2 * (6 if unit.words else 1)
    shards = max(partitions(spark), int(size / density) // ANCHORS_PER_SHARD + 1)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in H.pieces(batch, "text", BYTES_AT_ONCE):
                _, grams, bounds, _, _ = items_of(part.column("text"), unit)
                text, _, _, anchor, value = cut(grams, bounds, unit)
                place = (anchor - bounds[text]).astype("<u4")
                keys = np.array(part.column("key").to_pylist(), np.int64)[text]
                shard = (value % np.uint64(shards)).astype(np.int64)
                order = np.lexsort((place, text, shard))
                shard, text, place, keys = shard[order], text[order], place[order], keys[order]
                tail = (value[order] // np.uint64(shards)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
                edge = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]])) if len(shard) else []
                ends = np.append(edge[1:], len(shard)) if len(shard) else []
                out = [[], [], [], [], []]
                for a, b in zip(edge, ends):
                    run = np.flatnonzero(np.concatenate([[True], text[a + 1:b] != text[a:b - 1]]))
                    out[0].append(int(shard[a]))
                    out[1].append(tail[a:b].tobytes())
                    out[2].append(place[a:b].tobytes())
                    out[3].append(keys[a:b][run].tobytes())
                    out[4].append(np.diff(np.append(run, b - a)).astype("<u4").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.int32()), *(pa.array(x, pa.binary()) for x in out[1:])],
                    ["shard", "tails", "places", "keys", "counts"])

    def find(group, table):
        del group
        tails, places, keys = [], [], []
        for t, p, k, c in zip(*(table.column(x).to_pylist() for x in ("tails", "places", "keys", "counts"))):
            raw = np.zeros((len(t) // 5, 8), np.uint8)
            raw[:, :5] = np.frombuffer(t, np.uint8).reshape(-1, 5)
            tails.append(raw.view("<u8").ravel())
            places.append(np.frombuffer(p, "<u4"))
            keys.append(np.repeat(np.frombuffer(k, "<i8"), np.frombuffer(c, "<u4")))
        tails, places, keys = np.concatenate(tails), np.concatenate(places), np.concatenate(keys)
        order = np.argsort(tails)
        tails, places, keys = tails[order], places[order], keys[order]
        new = np.concatenate([[True], tails[1:] != tails[:-1]])
        runs = np.diff(np.append(np.flatnonzero(new), len(tails)))
        kept = np.repeat(runs, runs) > 1
        tails, places, keys = tails[kept], places[kept], keys[kept]
        # Rows that repeat id and text are one document: they do not make an anchor occur twice.
        order = np.lexsort((places, keys, tails))
        tails, places, keys = tails[order], places[order], keys[order]
        if len(tails):
            other = np.concatenate([[True], (tails[1:] != tails[:-1]) | (keys[1:] != keys[:-1]) | (places[1:] != places[:-1])])
            tails, places, keys = tails[other], places[other], keys[other]
            new = np.concatenate([[True], tails[1:] != tails[:-1]])
            runs = np.diff(np.append(np.flatnonzero(new), len(tails)))
            kept = np.repeat(runs, runs) > 1
            places, keys = places[kept], keys[kept]
        order = np.lexsort((places, keys))
        places, keys = places[order], keys[order]
        edge = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        ends = np.append(edge[1:], len(keys)) if len(keys) else edge
        return pa.table({"key": pa.array(keys[edge], pa.int64()),
                         "places": pa.array([places[a:b].tobytes() for a, b in zip(edge, ends)], pa.binary())})

    packed = docs.select("key", "text").mapInArrow(pack, "shard int, tails binary, places binary, keys binary, counts binary")
    found = packed.groupBy("shard").applyInArrow(find, "key long, places binary")
    return found.groupBy("key").agg(F.collect_list("places").alias("places"))


def segments(docs: DataFrame, unit: Unit) -> DataFrame:
    """One row per batch and different segment: shard, content, and of each occurrence the id, key and first item.

    Only segments whose anchor occurs more than once are there. ``shard`` groups all segments of an anchor; words are
    joined by one blank. Equal segments of a batch are merged before the shuffle.
    """
    spark = docs.sparkSession
    marks = stored(repeated_anchors(docs, unit), "anchors")
    held = F.aggregate("places", F.lit(0), lambda acc, p: acc + F.octet_length(p))
    volume = marks.agg(F.sum(held)).first()[0] or 0
    per_anchor = unit.length * 1.5 * (7 if unit.words else 1)
    shards = max(partitions(spark), int(volume / 4 * per_anchor / 2) // BYTES_PER_SHARD + 1)
    kind = docs.schema["id"].dataType

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in H.pieces(batch, "text", BYTES_AT_ONCE):
                data, grams, bounds, starts, ends = items_of(part.column("text"), unit)
                text, first, last, anchor, value = cut(grams, bounds, unit)
                marked = [np.frombuffer(b"".join(p), "<u4") for p in part.column("places").to_pylist()]
                counts = np.array([len(m) for m in marked], np.int64)
                wanted = np.concatenate(marked).astype(np.int64) + np.repeat(bounds[:-1], counts)
                flag = np.zeros(len(grams) + 1, bool)
                flag[wanted] = True
                keep = flag[anchor]
                text, first, last, value = text[keep], first[keep], last[keep], value[keep]
                shard = (value % np.uint64(shards)).astype(np.int64)
                begin = starts[first] if unit.words else first
                end = ends[last + unit.length - 1] if unit.words else last + unit.length
                raw = data.tobytes()
                found: dict = {}
                for s, i, a, b, f in zip(shard.tolist(), text.tolist(), begin.tolist(), end.tolist(),
                                         (first - bounds[text]).tolist()):
                    body = raw[a:b]
                    if unit.words:
                        body = b" ".join(body.split())
                    found.setdefault((s, body), []).append((i, f))
                at = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in found.values()], dtype=np.int64)]), pa.int32())
                rows = pa.array([i for x in found.values() for i, _ in x], pa.int64())
                firsts = pa.array([f for x in found.values() for _, f in x], pa.int64())
                yield pa.RecordBatch.from_arrays([
                    pa.array([s for s, _ in found], pa.int32()), pa.array([b for _, b in found], pa.binary()),
                    pa.ListArray.from_arrays(at, part.column("id").take(rows)),
                    pa.ListArray.from_arrays(at, part.column("key").take(rows)), pa.ListArray.from_arrays(at, firsts)],
                    ["shard", "content", "ids", "keys", "firsts"])

    schema = T.StructType([
        T.StructField("shard", T.IntegerType()), T.StructField("content", T.BinaryType()),
        T.StructField("ids", T.ArrayType(kind)), T.StructField("keys", T.ArrayType(T.LongType())),
        T.StructField("firsts", T.ArrayType(T.LongType()))])
    return docs.join(marks, "key").select("id", "key", "text", "places").mapInArrow(expand, schema)


def listed(column: pa.ChunkedArray) -> list:
    """The values of a column; numbers without nulls by way of numpy, which is faster."""
    plain = pa.types.is_integer(column.type) and not column.null_count
    return column.to_numpy().tolist() if plain else column.to_pylist()


def gathered(table: pa.Table):
    """Different contents of a shard and for each its occurrences (id, key, first), each document place once."""
    found: dict = {}
    table = table.combine_chunks()
    at = np.concatenate([[0], np.cumsum(pc.list_value_length(table["firsts"]).to_numpy())]).tolist()
    ids, keys, firsts = (listed(pc.list_flatten(table[x])) for x in ("ids", "keys", "firsts"))
    for content, a, b in zip(table["content"].to_pylist(), at, at[1:]):
        found.setdefault(content, set()).update(zip(ids[a:b], keys[a:b], firsts[a:b]))
    return list(found), [list(x) for x in found.values()]


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of true values."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def spans_by_key(keys: list, begins: list, ends: list) -> pa.Table:
    """Spans of a shard, those of a key that overlap or touch merged; one row per key with starts and ends."""
    keys, begins, ends = np.array(keys, np.int64), np.array(begins, np.int64), np.array(ends, np.int64)
    order = np.lexsort((begins, keys))
    out: dict = {}
    for k, a, b in zip(keys[order].tolist(), begins[order].tolist(), ends[order].tolist()):
        own = out.setdefault(k, ([], []))
        if own[1] and a <= own[1][-1]:
            own[1][-1] = max(own[1][-1], b)
        else:
            own[0].append(a)
            own[1].append(b)
    return pa.table({"key": pa.array(list(out), pa.int64()),
                     "begins": pa.array([x[0] for x in out.values()], pa.list_(pa.int64())),
                     "ends": pa.array([x[1] for x in out.values()], pa.list_(pa.int64()))})


SPANS = "key long, begins array<long>, ends array<long>"


def removal(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Documents with the spans found in all shards: id, text, begins, ends (lists of lists, null without spans).

    Texts are dealt by key here as in ``segments``, in the same job, so Spark moves them once and uses that shuffle twice.
    """
    per_key = spans.groupBy("key").agg(F.collect_list("begins").alias("begins"), F.collect_list("ends").alias("ends"))
    return docs.join(per_key, "key", "left").select("id", "text", "begins", "ends")


def covered(n: int, begins, ends) -> np.ndarray:
    """Which of ``n`` items the spans cover."""
    depth = np.zeros(n + 1, np.int64)
    for a, b in zip(begins or (), ends or ()):
        np.add.at(depth, np.array(a, np.int64), 1)
        np.add.at(depth, np.array(b, np.int64), -1)
    return np.cumsum(depth[:n]) > 0
