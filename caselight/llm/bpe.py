"""Byte-level BPE: merges from a priority queue over a doubly linked symbol list; decoding joins vocabulary strings."""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from caselight.llm import common  # noqa: F401  ships the package to Python workers

#: Fixed value: the pattern by which byte-level vocabularies of this kind split a text before merging.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pieces that a task remembers in each of two generations.
REMEMBERED = 150_000
#: Longer pieces are not remembered.
LONGEST = 64


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in such vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, extra = [""] * 256, 0
    for b in range(256):
        if b in plain:
            letters[b] = chr(b)
        else:
            letters[b] = chr(256 + extra)
            extra += 1
    return letters


class Codec:
    """Encoder and decoder of one vocabulary file; ``pairs`` maps two ids to (rank, merged id)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        letters = byte_letters()
        as_byte = {c: b for b, c in enumerate(letters)}
        self.byte_ids = [vocab[c] for c in letters]
        self.pairs = {}
        for rank, (a, b) in enumerate(spec["model"]["merges"]):
            self.pairs[vocab[a], vocab[b]] = (rank, vocab[a + b])
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = 1 + max([*vocab.values(), *self.special.values()])
        self.strings = [b""] * size
        for token, i in vocab.items():
            self.strings[i] = bytes(as_byte[c] for c in token)
        for token, i in self.special.items():
            self.strings[i] = token.encode()
        self.decimal = [str(i) for i in range(size)]
        self.pieces = regex.compile(PIECES).findall
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") \
            if self.special else None
        self.young, self.old = {}, {}

    def merge(self, data: bytes) -> tuple[int, ...]:
        """Ids of one piece: the pair of lowest rank, leftmost first, merges until no pair is left."""
        ids = [self.byte_ids[b] for b in data]
        n = len(ids)
        if n == 1:
            return (ids[0],)
        pairs = self.pairs
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))  # the linked list; n ends it
        queue = []
        for i in range(n - 1):
            found = pairs.get((ids[i], ids[i + 1]))
            if found:
                queue.append((found[0], i, found[1], ids[i], ids[i + 1]))
        heapq.heapify(queue)
        while queue:
            _, i, merged, left, right = heapq.heappop(queue)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue  # stale: a symbol was merged meanwhile
            ids[i], ids[j] = merged, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                found = pairs.get((merged, ids[k]))
                if found:
                    heapq.heappush(queue, (found[0], i, found[1], merged, ids[k]))
            h = before[i]
            if h >= 0:
                found = pairs.get((ids[h], merged))
                if found:
                    heapq.heappush(queue, (found[0], h, found[1], ids[h], merged))
        return tuple(i for i in ids if i >= 0)

    def piece(self, text: str) -> tuple[int, ...]:
        ids = self.old.get(text) or self.merge(text.encode())
        if len(text) <= LONGEST:
            if len(self.young) >= REMEMBERED:
                self.old, self.young = self.young, {}
            self.young[text] = ids
        return ids

    def _plain(self, text: str) -> Iterator[tuple[int, ...]]:
        known, piece = self.young, self.piece
        for p in self.pieces(text):
            ids = known.get(p)
            if ids is None:
                ids = piece(p)
                known = self.young
            yield ids

    def encode(self, text: str) -> list[int]:
        if not self.cut or not any(token in text for token in self.special):
            return list(chain.from_iterable(self._plain(text)))
        out = []
        for part in self.cut.split(text):
            if part in self.special:
                out.append(self.special[part])
            elif part:
                out.extend(chain.from_iterable(self._plain(part)))
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", "replace")


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", ids: bool = True,
                  decoded: bool = True, digests: bool = False) -> DataFrame:
    """One row per input row: id, n_tokens, and as asked the ids, the decoded text and digests of both.

    ``path`` is the vocabulary file, present on every executor. Null text is empty and has no ids. Strings of special
    tokens in a text become their ids. Rows are handled one by one, so repeated rows give repeated results; other columns
    are not read. No shuffle; a task remembers a bounded number of pieces.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_tokens long" + ", ids array<int>" * ids + ", decoded string" * decoded \
        + ", ids_sha256 string, decoded_sha256 string" * digests

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Codec(path)  # goes with its task: the worker process is used again by other stages
        for batch in batches:
            for at in range(0, batch.num_rows, 128):  # bounds what is held when texts are long
                part = batch.slice(at, 128)
                counts, lists, texts, id_hashes, text_hashes = [], [], [], [], []
                for text in part.column(1).to_pylist():
                    found = own.encode(text)
                    back = own.decode(found)
                    counts.append(len(found))
                    if ids:
                        lists.append(found)
                    if decoded:
                        texts.append(back)
                    if digests:
                        joined = ",".join(map(own.decimal.__getitem__, found))
                        id_hashes.append(hashlib.sha256(joined.encode()).hexdigest())
                        text_hashes.append(hashlib.sha256(back.encode()).hexdigest())
                columns = [part.column(0), pa.array(counts, pa.int64())]
                columns += [pa.array(lists, pa.list_(pa.int32()))] * ids + [pa.array(texts, pa.string())] * decoded
                if digests:
                    columns += [pa.array(id_hashes, pa.string()), pa.array(text_hashes, pa.string())]
                names = [id_col, "n_tokens"] + ["ids"] * ids + ["decoded"] * decoded \
                    + ["ids_sha256", "decoded_sha256"] * digests
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("__text")).mapInArrow(run, schema)
