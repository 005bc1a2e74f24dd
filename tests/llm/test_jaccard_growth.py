"""What op 4 compares grows with the number of texts, not with the square of a group."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from caselight.llm import jaccard
from caselight.llm.jaccard import Bands, prefix_size, shingle_sets, signatures
from tests.llm import brute
from tests.llm.conftest import prose


def shared_lists(texts):
    """Sizes of the lists of different sets that share a signature."""
    items, bounds = shingle_sets(pa.array(texts), 5)
    members = {}
    for step in (0, 1):
        sig, owner = signatures(items, bounds, Bands(80), step)
        for s, o in zip(sig.tolist(), owner.tolist()):
            members.setdefault(s, set()).add(o)
    return [len(x) for x in members.values() if len(x) > 1]


@pytest.mark.parametrize("least, most", [(5, 12), (12, 25), (25, 70)])
def test_unlike_short_texts_share_no_signature(least, most):
    rng = random.Random(1)
    for n in (1000, 4000):
        texts = [prose(rng, rng.randrange(least, most)) for _ in range(n)]
        assert sum(shared_lists(texts)) <= 4


@pytest.mark.parametrize("words", [9, 14, 20, 26, 33, 50, 90])
def test_similar_sets_share_a_signature(words):
    """Thin sets included: every pair of brute force is found."""
    rng = random.Random(words)
    for _ in range(150):
        text = prose(rng, words).split()
        other = list(text)
        for _ in range(rng.randrange(1, 3)):
            other[rng.choice([0, 1, -1, -2, rng.randrange(words)])] = "new"
        a, b = brute.shingles(" ".join(text)), brute.shingles(" ".join(other))
        if a != b and 100 * len(a & b) >= 80 * len(a | b):
            assert shared_lists([" ".join(text), " ".join(other)])


def test_prefixes_of_similar_sets_meet():
    rng = np.random.default_rng(3)
    for size in range(1, 60):
        for lost in range(0, size):
            for more in range(0, 12):
                if 100 * (size - lost) >= 80 * (size + more):
                    a = set(range(size))
                    b = set(range(lost, size)) | set(range(100, 100 + more))
                    order = rng.permutation(200)
                    first = lambda s: set(sorted(s, key=lambda x: order[x])[:prefix_size(len(s), 80)])
                    assert first(a) & first(b)


def near_group(rng, n):
    """Near copies of one text around the limit: some similar to each other, some to none."""
    base = prose(rng, 120).split()
    texts = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randrange(0, 7)):
            copy[rng.randrange(len(copy))] = f"new{rng.randrange(10 ** 6)}"
        texts.append(" ".join(copy))
    return texts


def test_rows_of_a_group_of_near_copies_grow_with_its_members(spark, monkeypatch):
    made = Counter()
    original = jaccard.stored

    def counted(df, name):
        out = original(df, name)
        if name == "closest":
            made[size] += out.count()
        return out

    monkeypatch.setattr(jaccard, "stored", counted)
    for size in (60, 240):
        texts = near_group(random.Random(5), size)
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
        found = {(r["doc_id"], r["component_id"]) for r in jaccard.jaccard_groups(docs).collect()}
        assert found == {(i, c) for i, _, c in brute.jaccard(list(enumerate(texts)))}
    assert made[240] <= 8 * max(made[60], 60)
