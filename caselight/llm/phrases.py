"""Phrase mining: an FM-index over word ids per shard, whose intervals are extended to the left and right; counts add up.

A shard is a bounded run of texts of one language inside a map task, so texts never move. Its index keeps the word ids of
the pieces (0 ends a piece), the order of all suffixes by their first ``max_words`` words, and the word before each suffix
(the BWT), once forward and once for the reversed text. An interval pair (rows of the phrase in the forward order, rows of
its reversal in the backward order) is extended by one word on either side; the size of an interval is the count of its
phrase in the shard. The order needs no more depth than the longest phrase, because a step only counts words that stand
before whole intervals.

Results for odd input: a null text has no words; a null language counts as ``und``; rows that repeat an id are separate
texts; an empty table gives no rows; long texts only make their shard larger (a shard holds one text at least); columns
other than text and language are not read, so clashing names do no harm. Ties of the score go to the more frequent
phrase, then to the smaller in byte order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from caselight.llm.common import stored

#: Bytes of text that a task gathers before it indexes them; bounds its memory, not the result.
SHARD_BYTES = 12_000_000
#: A language's candidates are ranked in so many slices first.
SLICES = 128
#: Rows of one Arrow batch on the way back.
BATCH_ROWS = 200_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CUT = np.zeros(256, bool)
_CUT[[*b".,;:!?", 10, 11, 12, 13]] = True
_GAP = _CUT.copy()
_GAP[[32, 9]] = True


def word_ids(text: bytes) -> tuple[np.ndarray, pa.Array]:
    """The words of a text as numbers from 1, with a 0 after each piece, and the words by number."""
    data = _LOWER[np.frombuffer(text, np.uint8)]
    gap = _GAP[data]
    edge = np.diff(np.concatenate([[True], gap, [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return np.zeros(0, np.int64), pa.array([], pa.binary())
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    letters = data[~gap]
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    coded = words.dictionary_encode()
    cuts = np.cumsum(_CUT[data])[starts]
    piece = np.concatenate([[0], np.cumsum(cuts[1:] != cuts[:-1])])
    ids = np.zeros(len(starts) + int(piece[-1]) + 1, np.int64)
    ids[np.arange(len(starts)) + piece] = coded.indices.to_numpy().astype(np.int64) + 1
    return ids, coded.dictionary


class Side:
    """One direction of the index: the BWT of the suffixes in the order of their first ``depth`` words."""

    def __init__(self, ids: np.ndarray, depth: int, size: int):
        padded = np.concatenate([ids, np.zeros(depth, np.int64)])
        if size ** depth < 2 ** 62:
            key = np.zeros(len(ids), np.int64)
            for k in range(depth):
                key = key * size + padded[k:k + len(ids)]
            order = np.argsort(key)
        else:
            order = np.lexsort([padded[k:k + len(ids)] for k in reversed(range(depth))])
        self.bwt = np.concatenate([[0], ids[:-1]])[order]
        self.rows = len(ids)
        self.ranked = np.sort(self.bwt * self.rows + np.arange(self.rows))

    def before(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """First row of ``symbol`` plus how often it occurs in the BWT above ``row``."""
        return np.searchsorted(self.ranked, symbol * self.rows + row)

    def extend(self, low: np.ndarray, other: np.ndarray, count: np.ndarray, size: int):
        """Every extension of the intervals by one word: (interval, word, low, low on the other side, count)."""
        owner = np.repeat(np.arange(len(low)), count)
        rows = np.arange(len(owner)) + np.repeat(low - (np.cumsum(count) - count), count)
        pairs, found = np.unique(owner * size + self.bwt[rows], return_counts=True)
        owner, symbol = pairs // size, pairs % size
        running = np.cumsum(found) - found
        smaller = running - running[np.searchsorted(owner, owner)]
        real = symbol > 0  # a piece ends there: counted as smaller, but no extension
        owner, symbol, found, smaller = owner[real], symbol[real], found[real], smaller[real]
        return owner, symbol, self.before(symbol, low[owner]), other[owner] + smaller, found


def phrases_of(ids: np.ndarray, max_words: int) -> Iterator[tuple[np.ndarray, np.ndarray, tuple | None]]:
    """For each length the phrases of a shard (one row of word numbers each), their counts, and for the last but one length
    how they go on: (phrase, next word, count). So the longest phrases are listed under what they start with; only
    ``max_words`` below 3 lists all lengths by themselves."""
    size = int(ids.max()) + 1
    count = np.bincount(ids, minlength=size)
    first = (np.cumsum(count) - count)[1:]
    phrases, count = np.arange(1, size)[:, None], count[1:]
    yield phrases, count, None
    if max_words == 1:
        return
    depth = max(2, max_words - 1)
    ahead, back = Side(ids, depth, size), Side(ids[::-1], depth, size)
    low = low_back = first
    for length in range(2, depth + 1):  # to the left: a step of the text itself
        owner, word, low, low_back, count = ahead.extend(low, low_back, count, size)
        phrases = np.concatenate([word[:, None], phrases[owner]], axis=1)
        more = None
        if length == max_words - 1:  # to the right: a step of the reversed text
            owner, word, _, _, found = back.extend(low_back, low, count, size)
            more = owner, word, found
        yield phrases, count, more


def _indexed(max_words: int):
    """Arrow function: gather texts by language, index each shard, hand on its phrases with their counts."""

    def shard(lang: str, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        ids, words = word_ids(b"\n".join(texts))
        texts.clear()
        if not len(ids):
            return
        yield batch([b""], [int(np.count_nonzero(ids))], [None], lang)
        for phrases, count, more in phrases_of(ids, max_words):
            for at in range(0, len(count), BATCH_ROWS):
                part = phrases[at:at + BATCH_ROWS] - 1
                columns = [words.take(pa.array(part[:, k])) for k in range(part.shape[1])]
                text = pc.binary_join_element_wise(*columns, b" ") if len(columns) > 1 else columns[0]
                yield batch(text, count[at:at + BATCH_ROWS], going_on(more, at, at + len(part), words), lang)

    def going_on(more: tuple | None, start: int, end: int, words: pa.Array):
        """The words that may follow each phrase, as one text; a count above 1 stands behind its word after a tab."""
        if more is None:
            return pa.nulls(end - start, pa.binary())
        owner, word, count = more
        a, b = np.searchsorted(owner, [start, end])
        text, many = words.take(pa.array(word[a:b] - 1)), pa.array(count[a:b])
        counted = pc.binary_join_element_wise(text, many.cast(pa.string()).cast(pa.binary()), b"\t")
        entries = pc.if_else(pc.greater(many, 1), counted, text)
        offsets = np.searchsorted(owner[a:b], np.arange(start, end + 1)).astype(np.int32)
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), entries), b" ")

    def batch(phrase, count, more, lang: str) -> pa.RecordBatch:
        phrase = phrase if isinstance(phrase, pa.Array) else pa.array(phrase, pa.binary())
        key = pc.binary_join_element_wise(phrase, lang.encode(), b"\n")
        more = more if isinstance(more, pa.Array) else pa.array(more, pa.binary())
        return pa.RecordBatch.from_arrays([key.cast(pa.string()), pa.array(count, pa.int64()), more.cast(pa.string())],
                                          ["key", "a", "more"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        size = 0
        for one in batches:
            langs, texts = one.column("lang").to_pylist(), one.column("text").cast(pa.large_binary())
            for lang, text in zip(langs, texts):
                raw = text.as_py()
                held.setdefault(lang, []).append(raw)
                size += len(raw)
                if size >= SHARD_BYTES:
                    for name, gathered in held.items():
                        yield from shard(name, gathered)
                    held, size = {}, 0
        for name, gathered in held.items():
            yield from shard(name, gathered)

    return run


def count_phrases(
    docs: DataFrame, max_words: int = 3, *, text_col: str = "text", lang_col: str = "lang", at_least: int = 1
) -> DataFrame:
    """(lang, words, phrase, a): how often each phrase of up to ``max_words`` words occurs inside pieces of the texts.

    One more row per language with words = 0 and an empty phrase holds the number of all words. Phrases below
    ``at_least`` are left out after all shards were added up.

    Only one shuffle, by phrase: the longest phrases travel as continuations of the row that they start with, and are
    looked at only where that one is frequent enough. A shard sends each phrase once, so the most frequent phrase has as
    many rows as there are shards.
    """
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # The key is the phrase, a line feed (which no word contains) and the language.
    found = texts.mapInArrow(_indexed(max_words), "key string, a bigint, more string").repartition("key")
    total = F.sum("a").over(Window.partitionBy("key"))
    frequent = found.withColumn("total", total).where(F.col("key").startswith("\n") | (F.col("total") >= at_least))
    going_on = F.when(F.col("more") != "", F.split("more", " ")).otherwise(F.array().cast("array<string>"))  # "": it never does
    entries = F.concat(F.array(F.lit(None).cast("string")), going_on)
    parts = frequent.select("key", "a", F.explode(entries).alias("entry"))
    parts = parts.select("key", F.split_part("entry", F.lit("\t"), F.lit(1)).alias("next"), F.when(
        F.col("entry").isNull(), F.col("a")).when(F.col("entry").contains("\t"), F.split_part(
            "entry", F.lit("\t"), F.lit(2)).cast("bigint")).otherwise(1).alias("a"))
    summed = parts.groupBy("key", "next").agg(F.sum("a").alias("a")).where(
        F.col("key").startswith("\n") | (F.col("a") >= at_least))
    start = F.substring_index("key", "\n", 1)
    phrase = F.when(F.col("next").isNull(), start).otherwise(F.concat_ws(" ", start, F.col("next")))
    named = summed.select(F.expr("substring(key, instr(key, '\n') + 1)").alias("lang"), phrase.alias("phrase"), "a")
    return named.select("lang", F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " "))).alias("words"),
                        "phrase", "a")


def _span(words: Column, start: int | Column, length: int | Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def collocations(
    docs: DataFrame, *, min_words: int = 2, max_words: int = 3, min_count: int = 10, covered_percent: int = 50,
    top: int = 2000, text_col: str = "text", lang_col: str = "lang",
) -> DataFrame:
    """The best collocations of each language: (lang, rank, phrase, words, k, a, l, r, n, score).

    A candidate has ``min_words`` to ``max_words`` words and occurs ``min_count`` times. Cut after word k into parts that
    occur l and r times it scores floor(1000000 * a * a / (l * r)); its weakest cut counts, the first of equals. Candidates
    that lie inside a longer one with at least ``covered_percent`` of their count are dropped.
    """
    counts = stored(count_phrases(docs, max_words, text_col=text_col, lang_col=lang_col, at_least=min_count), "phrases")
    long_enough = counts.where(F.col("words") >= min_words)
    # A part of a candidate occurs as often as the candidate at least, so it is among the counts.
    parts = counts.where(F.col("words").between(1, max_words - 1)).select(
        "lang", F.col("phrase").alias("part"), F.col("a").alias("occurs"))
    wide = lambda name: F.col(name).cast("decimal(38,0)")
    cuts = long_enough.withColumn("w", F.split("phrase", " ")).select(
        "lang", "phrase", "words", "a", "w", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")).select(
        "lang", "phrase", "words", "a", "k", _span(F.col("w"), 1, F.col("k")).alias("left_part"),
        _span(F.col("w"), F.col("k") + 1, F.col("words") - F.col("k")).alias("right_part"))
    for side, name in (("left_part", "l"), ("right_part", "r")):
        cuts = cuts.join(parts.select("lang", F.col("part").alias(side), F.col("occurs").alias(name)), ["lang", side])
    scored = cuts.withColumn(
        "score", F.expr("cast(1000000 * cast(a as decimal(15,0)) * cast(a as decimal(15,0)) as decimal(38,0))"
                        " div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))"))
    weakest = scored.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = long_enough.where(F.col("words") > min_words).withColumn("w", F.split("phrase", " ")).select(
        "lang", "a", "w", "words", F.explode(F.sequence(F.lit(min_words), F.col("words") - 1)).alias("m")).select(
        "lang", "a", "w", "m", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("m") + 1)).alias("at")).select(
        "lang", _span(F.col("w"), F.col("at"), F.col("m")).alias("phrase"), "a")
    longest = inner.groupBy("lang", "phrase").agg(F.max("a").alias("in_longer"))
    free = weakest.join(longest, ["lang", "phrase"], "left").where(
        F.col("in_longer").isNull() | (100 * wide("in_longer") < covered_percent * wide("a")))
    totals = counts.where("words = 0").select("lang", F.col("a").alias("n"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # First the best of each slice of a language, so that no task sorts all its candidates; their best are the best of all.
    slices = Window.partitionBy("lang", "slice").orderBy(*order)
    best = free.select("lang", "phrase", "words", "a", "cut.*", F.pmod(F.xxhash64("phrase"), F.lit(SLICES)).alias("slice"))
    best = best.withColumn("place", F.row_number().over(slices)).where(F.col("place") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return best.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "words", "k", "a", "l", "r", "n",
        F.col("score").cast("long").alias("score"))
