"""Substring deduplication of words with an FM-index per shard.

``segments`` brings all copies of a window together. A shard builds an FM-index of its segments: the transform of its
words lies in a wavelet tree of packed bit vectors with block counts. Its segments are then streamed through the index by
backward search, all at once: a segment is extended to the left while it still occurs twice; what that leaves is searched
window by window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from caselight.llm import hashing as H, segments as S
from caselight.llm.suffix import suffix_order

GRAM = 8


class Bits:
    """Packed bits with a count before each block of 64."""

    def __init__(self, flags: np.ndarray):
        n = len(flags) // 64 + 1
        padded = np.zeros(n * 64, bool)
        padded[:len(flags)] = flags
        self.blocks = np.packbits(padded, bitorder="little").view("<u8")
        counts = np.bitwise_count(self.blocks).astype(np.int64)
        self.before = (np.cumsum(counts) - counts).astype(np.int32)

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        block, rest = i >> 6, (i & 63).astype(np.uint64)
        part = self.blocks[block] & ((np.uint64(1) << rest) - np.uint64(1))
        return self.before[block] + np.bitwise_count(part)


class Wavelet:
    """A wavelet tree stored level by level: zeros go left, ones right, each level one bit vector."""

    def __init__(self, symbols: np.ndarray, top: int):
        self.levels = max(1, int(top).bit_length())
        self.bits, self.zeros = [], []
        now = symbols
        for level in range(self.levels):
            one = (now >> (self.levels - 1 - level)) & 1 == 1
            self.bits.append(Bits(one))
            self.zeros.append(int(len(now) - one.sum()))
            now = np.concatenate([now[~one], now[one]])
        self.start = self._starts(now, top)

    @staticmethod
    def _starts(now: np.ndarray, top: int) -> np.ndarray:
        first = np.zeros(top + 2, np.int64)
        new = np.flatnonzero(np.concatenate([[True], now[1:] != now[:-1]])) if len(now) else np.zeros(0, np.int64)
        first[now[new]] = new
        return first

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        first = self.start[symbol]
        for level in range(self.levels):
            ones = self.bits[level].rank(i)
            is_one = (symbol >> (self.levels - 1 - level)) & 1 == 1
            i = np.where(is_one, self.zeros[level] + ones, i - ones)
        return i - first


class FMIndex:
    """Counts occurrences of word sequences; symbols are 1 to ``top``. Right for sequences of up to ``depth`` symbols."""

    def __init__(self, text: np.ndarray, top: int, depth: int):
        order = suffix_order(text, depth)
        self.n = len(text)
        self.tree = Wavelet(text[order - 1], top)  # the symbol before each suffix; the first one has the last
        counts = np.bincount(text, minlength=top + 2)
        self.less = np.cumsum(counts) - counts

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of backward search for many ranges at once."""
        both = self.tree.rank(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        base = self.less[symbol]
        return base + both[:len(symbol)], base + both[len(symbol):]

    def reach(self, text: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """For each span of ``text`` the least start from which it occurs at least twice up to its end."""
        low, high = np.zeros(len(begin), np.int64), np.full(len(begin), self.n, np.int64)
        at = end.copy()
        alive = np.flatnonzero(begin < end)
        while len(alive):
            symbol = text[at[alive] - 1]
            a, b = self.extend(symbol, low[alive], high[alive])
            twice = b - a >= 2
            alive = alive[twice]
            low[alive], high[alive] = a[twice], b[twice]
            at[alive] -= 1
            alive = alive[at[alive] > begin[alive]]
        return at


def repeated_windows(table: pa.Table, length: int) -> pa.Table:
    """Spans (in words) of a shard that windows cover which occur more than once."""
    contents, places = S.gathered(table)
    lists = [c.split(b" ") for c in contents]
    names = {w: i for i, w in enumerate(sorted({w for words in lists for w in words}), start=2)}
    top = len(names) + 1
    parts = []
    for words in lists:
        parts.append([names[w] for w in words])
        parts.append([1])
    text = np.concatenate([np.array(p, np.int64) for p in parts])
    sizes = np.array([len(w) for w in lists])
    at = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    copied = np.array([len(own) > 1 for own in places])
    index = FMIndex(text, top, max(length, int(sizes.max())) + 1)
    flags = np.zeros(len(text), bool)  # of window starts
    single = np.flatnonzero(~copied)
    reached = index.reach(text, at[single], at[single] + sizes[single])
    last = at[single] + sizes[single] - length
    left = []
    for j, r, z in zip(single.tolist(), reached.tolist(), last.tolist()):
        flags[min(r, z + 1):z + 1] = True
        if r > at[j]:
            left.append(np.arange(at[j], min(r, z + 1)))
    if left:
        begin = np.concatenate(left)
        flags[begin[index.reach(text, begin, begin + length) == begin]] = True
    for j in np.flatnonzero(copied).tolist():
        flags[at[j]:at[j] + sizes[j] - length + 1] = True
    keys, begins, ends = [], [], []
    run_from, run_to = S.runs(flags)
    for a, b in zip(run_from.tolist(), run_to.tolist()):
        j = int(np.searchsorted(at, a, side="right")) - 1
        for _, key, first in places[j]:
            keys.append(key)
            begins.append(first + a - int(at[j]))
            ends.append(first + b - int(at[j]) + length - 1)
    return S.spans_by_key(keys, begins, ends)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 35,
                   kept_text: bool = False) -> DataFrame:
    """Remove each word covered by a window of ``length`` words whose sequence also starts anywhere else.

    Windows are judged on the input; words are compared unchanged. Rows that repeat id and text are one document and all
    get its result. Null text has no words. Returns one row per input row: id, n_words, n_removed, kept_sha256 (of the
    words that stay, joined by blanks), and with ``kept_text`` that text. Other columns are not read.
    """
    if length < 2 * GRAM:
        raise ValueError(f"windows of less than {2 * GRAM} words have too few anchors")
    rows = S.rows_of(docs, id_col, text_col)
    shards = S.segments(rows, S.Unit(True, length, GRAM))
    spans = shards.groupBy("shard").applyInArrow(lambda group, table: repeated_windows(table, length), S.SPANS)
    joined = S.removal(rows, spans)
    kind = docs.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in H.pieces(batch, "text"):
                out = [[], [], [], []]
                for text, begins, ends in zip(*(part.column(x).to_pylist() for x in ("text", "begins", "ends"))):
                    words = text.encode().split()
                    n = len(words)
                    if begins:
                        gone = S.covered(n, begins, ends)
                        words = [w for w, g in zip(words, gone.tolist()) if not g]
                    kept = b" ".join(words)
                    for column, value in zip(out, (n, n - len(words), hashlib.sha256(kept).hexdigest(), kept.decode())):
                        column.append(value)
                columns = [part.column("id"), *(pa.array(x, pa.int64()) for x in out[:2]), pa.array(out[2], pa.string())]
                names = [id_col, "n_words", "n_removed", "kept_sha256"]
                if kept_text:
                    columns.append(pa.array(out[3], pa.string()))
                    names.append("kept")
                yield pa.RecordBatch.from_arrays(columns, names)

    return joined.mapInArrow(cut, f"`{id_col}` {kind}, n_words long, n_removed long, kept_sha256 string"
                             + ", kept string" * kept_text)
