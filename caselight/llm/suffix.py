"""Suffix-array deduplication of byte strings, shard by shard with the difference-cover construction.

``segments`` brings all copies of a window together. A shard sorts the suffixes of its segments: triples at two of three
positions are sorted and named, the names sorted by recursion, and the remaining suffixes merged in by comparing one or
two symbols and a known rank. Neighbours in the order that agree in a whole window are copies of each other; of each class
the first place in the corpus stays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from caselight.llm import hashing as H, segments as S

#: Bytes of the grams that choose anchors.
GRAM = 32


def _order(keys: tuple[np.ndarray, ...], tops: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows by several keys (equal rows in any order), and a dense rank (from 1) along that order."""
    width = 1
    for top in tops:
        width *= top
    if width < 1 << 62:
        joined = keys[0].astype(np.int64)
        for key, top in zip(keys[1:], tops[1:]):
            joined = joined * top + key
        order = np.argsort(joined)
        joined = joined[order]
        new = joined[1:] != joined[:-1]
    else:
        order = np.lexsort(keys[::-1])
        new = np.zeros(max(len(order) - 1, 0), bool)
        for key in keys:
            sorted_key = key[order]
            new |= sorted_key[1:] != sorted_key[:-1]
    return order, np.cumsum(np.concatenate([[1], new])) if len(order) else np.zeros(0, np.int64)


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions of all suffixes in an order that is right for their first ``depth`` symbols at least (symbols >= 1)."""
    n = len(text)
    if n < 4:
        return np.array(sorted(range(n), key=lambda i: text[i:].tolist()), np.int64)
    top = int(text.max()) + 1
    s = np.concatenate([text.astype(np.int64), np.zeros(3, np.int64)])
    ones = np.arange(1, n + (n % 3 == 1), 3)  # with a place after the end if needed, so that all of class 0 have a next
    twos = np.arange(2, n, 3)
    sample = np.concatenate([ones, twos])
    order, name = _order((s[sample], s[sample + 1], s[sample + 2]), (top, top, top))
    names = np.empty(len(sample), np.int64)
    names[order] = name
    if depth > 3 and name[-1] < len(sample):
        sub = suffix_order(names, -(-depth // 3))
        sorted_sample = sample[sub]
        # Suffixes that agree further than needed may share a name but not a place; any order will do for them.
        rank_of = np.empty(len(sample), np.int64)
        rank_of[sub] = np.arange(1, len(sample) + 1)
    else:
        sorted_sample, rank_of = sample[order], names
    rank = np.zeros(n + 4, np.int64)
    rank[sample] = rank_of
    most = len(sample) + 1
    zeros = np.arange(0, n, 3)
    order, _ = _order((s[zeros], rank[zeros + 1]), (top, most))
    zeros = zeros[order]
    sorted_sample = sorted_sample[sorted_sample < n]
    first, second = sorted_sample[sorted_sample % 3 == 1], sorted_sample[sorted_sample % 3 == 2]
    after_first = np.searchsorted(s[first] * most + rank[first + 1], s[zeros] * most + rank[zeros + 1])
    if top * top * most < 1 << 62:
        def key(i):
            return (s[i] * top + s[i + 1]) * most + rank[i + 2]
        after_second = np.searchsorted(key(second), key(zeros))
    else:
        both = np.concatenate([second, zeros])
        order, dense = _order((s[both], s[both + 1], rank[both + 2]), (top, top, most))
        value = np.empty(len(both), np.int64)
        value[order] = dense
        after_second = np.searchsorted(value[:len(second)], value[len(second):])
    out = np.empty(n, np.int64)
    place = np.arange(len(zeros)) + after_first + after_second
    taken = np.zeros(n, bool)
    # Ties beyond the depth can make two counts disagree; places stay distinct and in order.
    place = np.maximum.accumulate(place - np.arange(len(zeros))) + np.arange(len(zeros))
    taken[place] = True
    out[place] = zeros
    out[~taken] = sorted_sample
    return out


def equal_neighbours(data: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Whether each suffix (but the first) agrees with the one before it in ``length`` bytes."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    eight = np.zeros(len(data), np.uint64)
    for k in range(8):
        eight |= padded[k:k + len(data)] << np.uint64(8 * k)
    here, before = order[1:], order[:-1]
    alive = np.arange(len(here))
    for step in [*range(0, length - 8, 8), length - 8]:
        alive = alive[eight[here[alive] + step] == eight[before[alive] + step]]
    out = np.zeros(len(here), bool)
    out[alive] = True
    return out


def repeated_spans(table: pa.Table, length: int) -> pa.Table:
    """Spans of a shard that windows cover which also start earlier."""
    contents, places = S.gathered(table)
    for own in places:
        own.sort(key=lambda p: (p[0] is None, p[0], p[1], p[2]) if p[0] is not None else (True, 0, p[1], p[2]))
    keys, begins, ends = [], [], []
    for content, own in zip(contents, places):
        for _, key, first in own[1:]:  # copies of a whole segment
            keys.append(key)
            begins.append(first)
            ends.append(first + len(content))
    sizes = np.array([len(c) for c in contents])
    data = np.frombuffer(b"\0".join(contents) + b"\0", np.uint8)
    at = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    symbols = data.astype(np.int64) + 2
    symbols[at + sizes] = 1  # ends a segment, below every byte
    valid = np.zeros(len(data), bool)
    for a, n in zip(at.tolist(), sizes.tolist()):
        valid[a:a + n - length + 1] = True
    order = suffix_order(symbols, length)
    order = order[valid[order]]
    firsts = [own[0] for own in places]
    docs = {d: i for i, d in enumerate(sorted({(p[0] is None, p[0] if p[0] is not None else 0, p[1]) for p in firsts}))}
    number = np.array([docs[(p[0] is None, p[0] if p[0] is not None else 0, p[1])] for p in firsts])
    segment = np.searchsorted(at, order, side="right") - 1
    offset = order - at[segment]
    place = (number[segment].astype(np.int64) << np.int64(40)) + np.array([p[2] for p in firsts], np.int64)[segment] + offset
    start = np.flatnonzero(np.concatenate([[True], ~equal_neighbours(data, order, length)]))
    least = np.minimum.reduceat(place, start)
    later = place != np.repeat(least, np.diff(np.append(start, len(place))))
    flags = np.zeros(len(data), bool)
    flags[order[later]] = True
    run_from, run_to = S.runs(flags)
    for a, b in zip(run_from.tolist(), run_to.tolist()):
        j = int(np.searchsorted(at, a, side="right")) - 1
        keys.append(firsts[j][1])
        begins.append(firsts[j][2] + a - int(at[j]))
        ends.append(firsts[j][2] + b - int(at[j]) + length - 1)
    return S.spans_by_key(keys, begins, ends)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100,
                   kept_bytes: bool = False) -> DataFrame:
    """Remove each byte covered by a string of ``length`` bytes that also starts earlier in the corpus.

    Earlier means a smaller id (null last), or an earlier start in the same document; documents that share an id but not
    the text are ordered by a hash. Rows that repeat id and text are one document and all get its result. Null text is
    empty. Returns one row per input row: id, n_bytes, n_removed, n_spans, kept_sha256, and with ``kept_bytes`` the
    bytes that stay. Other columns are not read.
    """
    if length < 2 * GRAM:
        raise ValueError(f"strings shorter than {2 * GRAM} bytes have too few anchors")
    rows = S.rows_of(docs, id_col, text_col)
    shards = S.segments(rows, S.Unit(False, length, GRAM))
    spans = shards.groupBy("shard").applyInArrow(lambda group, table: repeated_spans(table, length), S.SPANS)
    joined = S.removal(rows, spans)
    kind = docs.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in H.pieces(batch, "text"):
                data, at = H.flat(part.column("text"))
                out = [[], [], [], [], []]
                for i, (begins, ends) in enumerate(zip(part.column("begins").to_pylist(), part.column("ends").to_pylist())):
                    own = data[at[i]:at[i + 1]]
                    gone = S.covered(len(own), begins, ends) if begins else np.zeros(len(own), bool)
                    kept = own[~gone].tobytes() if begins else own.tobytes()
                    for column, value in zip(out, (len(own), int(gone.sum()), len(S.runs(gone)[0]) if begins else 0,
                                                   hashlib.sha256(kept).hexdigest(), kept)):
                        column.append(value)
                columns = [part.column("id"), *(pa.array(x, pa.int64()) for x in out[:3]), pa.array(out[3], pa.string())]
                names = [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256"]
                if kept_bytes:
                    columns.append(pa.array(out[4], pa.binary()))
                    names.append("kept")
                yield pa.RecordBatch.from_arrays(columns, names)

    return joined.mapInArrow(cut, f"`{id_col}` {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
                             + ", kept binary" * kept_bytes)
