"""Word and shingle hashes of whole batches of texts, computed on arrays of bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def scramble(value: int) -> int:
    return int(mix(np.array([value & _MASK], np.uint64))[0])


_LETTER = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_LETTER_LOWER = _LETTER.copy()
_LETTER_LOWER[65:91] = _LETTER[97:123]
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64."""
    out = np.ones(max(n, 1), np.uint64)
    done = 1
    while done < n:
        step = min(done, n - done)
        out[done:done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
        done += step
    return out


_UNBASE = pow(_BASE, -1, 1 << 64)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of texts without nulls, one after the other, and where each text starts and ends."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], at - at[0]


def pieces(batch: pa.RecordBatch, column: str, most_bytes: int = 500_000):
    """Slices of a batch that hold at most so many bytes of text, or one row."""
    sizes = np.diff(flat(batch.column(column))[1])
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > most_bytes:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(n)
    if start < batch.num_rows:
        yield batch.slice(start)


def word_spans(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and where the words of each text start and end."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(at), np.int64)
    space = _IS_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    before = np.empty(len(data), bool)
    before[0] = True
    before[1:] = space[:-1]
    before |= edge[:-1]
    after = np.empty(len(data), bool)
    after[-1] = True
    after[:-1] = space[1:]
    after |= edge[1:]
    starts, ends = np.flatnonzero(~space & before), np.flatnonzero(~space & after) + 1
    return starts, ends, np.searchsorted(starts, at)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """One 64-bit hash per word; with ``lower`` A-Z count as a-z."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    run = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_LETTER_LOWER if lower else _LETTER)[data] * powers(_BASE, len(data)), out=run[1:])
    back = powers(_UNBASE, len(data))
    return mix((run[ends] - run[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def gram_hashes(items: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive items; runs that cross a border are for the caller to leave out."""
    if len(items) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(items) - n + 1, np.uint64)
    for k in range(n):
        out += items[k:len(items) - n + 1 + k] * np.uint64(pow(_BASE, k + 1, 1 << 64))
    return mix(out)
