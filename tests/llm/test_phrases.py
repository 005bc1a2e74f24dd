"""Phrase mining against brute force: counts, cuts, covered phrases, ties, odd input."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from caselight.llm import phrases
from tests.llm.conftest import rows


def pieces(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [p for p in (re.findall(r"[^\x20\x09]+", piece) for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered)) if p]


def brute_counts(docs, most):
    count, total = {}, Counter()
    for lang, text in docs:
        for w in pieces(text):
            total[lang or "und"] += len(w)
            for m in range(1, most + 1):
                for i in range(len(w) - m + 1):
                    key = (lang or "und", tuple(w[i:i + m]))
                    count[key] = count.get(key, 0) + 1
    return count, total


def brute(docs, least, most, min_count, percent, top):
    count, total = brute_counts(docs, most)
    found = {k: a for k, a in count.items() if len(k[1]) >= least and a >= min_count}
    out = {}
    for (lang, w), a in found.items():
        longer = [b for (other, v), b in found.items() if other == lang and len(v) > len(w)
                  and any(v[i:i + len(w)] == w for i in range(len(v)))]
        if any(100 * b >= percent * a for b in longer):
            continue
        cuts = [(10 ** 6 * a * a // (count[lang, w[:k]] * count[lang, w[k:]]), k, count[lang, w[:k]], count[lang, w[k:]])
                for k in range(1, len(w))]
        score, k, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right, k))
    return sorted((lang, rank, p.decode(), k, -a, left, right, total[lang], -score) for lang, listed in out.items()
                  for rank, (score, a, p, left, right, k) in enumerate(sorted(listed)[:top], 1))


def mined(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "k", "a", "l", "r", "n", "score")) for r in df.collect())


@pytest.mark.parametrize("least, most", [(2, 3), (2, 2), (3, 5)])
def test_messy_texts(messy, messy_rows, least, most, monkeypatch):
    monkeypatch.setattr(phrases, "SHARD_BYTES", 3000)  # many shards: their counts add up
    docs = [(r[2], r[1]) for r in messy_rows]
    assert mined(phrases.collocations(messy, min_words=least, max_words=most, min_count=3)) == \
        brute(docs, least, most, 3, 50, 2000)


def test_small_alphabet_with_ties(spark):
    rng = random.Random(3)
    docs = [(rng.choice(["x", None]), "".join(rng.choice(["a", "B", " b", "é", " ", "\t", ",", "\n", "c "]) for _ in range(400)))
            for _ in range(60)]
    df = spark.createDataFrame(docs, "lang string, text string")
    assert mined(phrases.collocations(df, min_count=2, top=25)) == brute(docs, 2, 3, 2, 50, 25)


def test_interval_counts_do_not_depend_on_how_ids_are_packed(monkeypatch):
    ids = np.array([random.Random(1).randrange(0, 7) for _ in range(500)] + [0])
    ids = ids[np.sort(np.unique(np.concatenate([[0], np.flatnonzero(np.diff(ids)) + 1])))]
    text = ids.tolist()
    def expected(m):
        return Counter(tuple(text[i:i + m]) for i in range(len(text) - m + 1) if 0 not in text[i:i + m])

    for words, count, more in phrases.phrases_of(ids, 4):
        assert {tuple(w): c for w, c in zip(words.tolist(), count.tolist())} == expected(words.shape[1])
    longest = {(*words[i].tolist(), w): c for i, w, c in zip(*(x.tolist() for x in more))}
    assert words.shape[1] == 3 and longest == expected(4)
    wide = phrases.Side(ids, 3, 2 ** 40)  # sorted by several keys instead of one packed number
    assert (wide.bwt == phrases.Side(ids, 3, 8).bwt).mean() > 0.5


def test_exact_beyond_64_bits(spark):
    counts = spark.createDataFrame([(10 ** 13, 10 ** 13 + 7, 10 ** 13 + 9)], "a bigint, l bigint, r bigint")
    score = counts.select(F.expr("cast(1000000 * cast(a as decimal(15,0)) * cast(a as decimal(15,0)) as decimal(38,0))"
                                 " div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))").alias("s")).first()["s"]
    assert score == 10 ** 32 // ((10 ** 13 + 7) * (10 ** 13 + 9))


def test_empty_table_and_clashing_names(spark, nothing):
    assert phrases.collocations(nothing).count() == 0
    df = spark.createDataFrame([("a b a b a b", "xx", 1, 2, 3)], "text string, lang string, phrase int, a int, words int")
    assert rows(phrases.collocations(df, min_count=2, max_words=2), "phrase", "a") == [("a b", 3), ("b a", 2)]


def test_one_language_is_ranked_in_slices(spark):
    rng = random.Random(11)
    docs = [("en", sentence) for sentence in (" ".join(rng.choice("abcdefgh") for _ in range(40)) for _ in range(50))]
    df = spark.createDataFrame(docs, "lang string, text string")
    assert mined(phrases.collocations(df, min_count=1, top=7)) == brute(docs, 2, 3, 1, 50, 7)


def test_phrases_that_end_their_piece_in_many_shards(spark):
    """A phrase that never goes on in a shard has no continuation there, not an empty one that counts as a longer phrase."""
    docs = [("en", "Alpha beta. gamma" + f"\tdelta x{i}" * (i % 2)) for i in range(24)]
    df = spark.createDataFrame(docs, "lang string, text string").repartition(24, "text")
    df = df.union(df).coalesce(48)
    assert {r["phrase"] for r in phrases.count_phrases(df).collect() if r["phrase"] != r["phrase"].strip()} == set()
    assert mined(phrases.collocations(df)) == brute(docs * 2, 2, 3, 10, 50, 2000)
