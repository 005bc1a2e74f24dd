"""What the stages of the pipeline hand on: whole rows under any names, one choice in every run, nothing for nothing."""

import random

import pytest
from pyspark.sql import functions as F

from caselight.llm import bpe, exact, fmindex, jaccard, mixing, quality, suffix
from caselight.llm.queries import vocabulary
from tests.llm import brute
from tests.llm.conftest import prose, rows

CLASHES = ["__key", "__digest", "__keep", "__group", "__copy", "__copies", "__text", "__quality", "row", "key", "id", "digest",
           "points", "whole", "copies", "grouped", "keep_id", "a.b", "component_id"]
STAGES = {"quality": quality.keep_good, "exact": exact.drop_copies, "jaccard": jaccard.drop_similar, "mixing": mixing.take_documents}


@pytest.fixture(scope="module")
def clashing(spark):
    rng = random.Random(3)
    base = prose(rng, 80)
    texts = [base, base + " ", base.replace("a", "e", 1)] + [prose(rng, rng.randrange(30, 90)) for _ in range(40)]
    data = [(i, t, "en", f"s{i % 2}", *[f"{name} of {i}" for name in CLASHES]) for i, t in enumerate(texts)]
    names = ", ".join(f"`{name}` string" for name in CLASHES)
    return spark.createDataFrame(data, f"doc_id long, text string, lang string, source string, {names}").repartition(3)


@pytest.mark.parametrize("name", STAGES)
def test_columns_of_any_name_come_back(clashing, name):
    before = {r["doc_id"]: tuple(r) for r in clashing.collect()}
    after = STAGES[name](clashing)
    assert after.columns == clashing.columns
    found = after.collect()
    assert found and all(tuple(r) == before[r["doc_id"]] for r in found)


@pytest.mark.parametrize("name", STAGES)
def test_empty_table(nothing, name):
    out = STAGES[name](nothing)
    assert out.columns == nothing.columns and out.collect() == []


def test_choice_among_repeated_ids_is_the_same_in_every_run(spark):
    rng = random.Random(4)
    data = [(1, "same text" + " " * (k % 3), f"m{k}") for k in range(9)] + [(2, "same  text", "z"), (None, "other", "a"), (None, "other", "b")]
    seen = set()
    for run in range(4):
        rng.shuffle(data)
        df = spark.createDataFrame(data, "doc_id long, text string, more string").repartition(1 + run)
        seen.add(tuple(rows(exact.drop_copies(df), "doc_id", "text", "more")))
    assert len(seen) == 1
    kept = seen.pop()
    assert [r[0] for r in kept] == [1, None] and kept[0][1] == "same text  "


def test_long_texts(spark):
    """One text of 150,000 words beside short ones, for the operators that read whole texts."""
    rng = random.Random(5)
    long = prose(rng, 150_000)
    passage = " ".join(long.split()[70_000:70_120])
    data = [(0, long), (1, long + " end"), (2, passage), (3, "short text")]
    df = spark.createDataFrame(data, "doc_id long, text string").withColumns({"lang": F.lit("en"), "source": F.lit("s")})
    counted = {r["doc_id"]: r for r in quality.judge(df).collect()}
    assert [counted[i]["n_words"] for i, _ in data] == [len(brute.words(t)) for _, t in data]
    assert rows(jaccard.jaccard_groups(df), "doc_id", "n_shingles", "component_id") == sorted(
        (i, len(brute.shingles(t)), 0 if i == 1 else i) for i, t in data)
    coded = {r["doc_id"]: r["decoded"] for r in bpe.encode_decode(df, vocabulary()).collect()}
    assert all(coded[i] == t for i, t in data)
    cut = {r["doc_id"]: r for r in fmindex.remove_repeats(df, kept_text=True).collect()}
    assert cut[2]["n_removed"] == 120 and cut[1]["n_removed"] == 150_000 and cut[1]["kept"] == "end"


def test_kept_bytes_and_text_are_what_the_digests_say(spark, messy):
    found = suffix.remove_repeats(messy, kept_bytes=True).collect()
    assert all(brute.sha(bytes(r["kept"])) == r["kept_sha256"] and len(r["kept"]) == r["n_bytes"] - r["n_removed"] for r in found)
    assert any(r["n_removed"] for r in found)
    found = fmindex.remove_repeats(messy, kept_text=True).collect()
    assert all(brute.sha(r["kept"]) == r["kept_sha256"] for r in found) and any(r["n_removed"] for r in found)


def test_mix_of_documents_meets_the_targets(spark):
    """Words of each source in the mix of whole documents against targets worked out by hand."""
    rng = random.Random(6)
    sizes = {"a": 400, "b": 300, "c": 60, None: 500}
    data = [(i, prose(rng, rng.randrange(10, 60)), s) for s, n in sizes.items() for i in range(n)]
    data = [(k, t, s) for k, (_, t, s) in enumerate(data)]
    words = {s: sum(len(brute.words(t)) for _, t, x in data if x == s) for s in sizes}
    total, weight = sum(words.values()), dict(zip(["a", "b", "c", None], [5, 2, 1, 5]))
    goal, left = {}, set(sizes)
    while True:
        rest = total - sum(goal.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in left) for s in left}
        over = [s for s in left if share[s] > 3 * words[s]]
        if not over:
            break
        goal |= {s: 3 * words[s] for s in over}
        left -= set(over)
    goal |= share
    taken = mixing.take_documents(spark.createDataFrame(data, "doc_id long, text string, source string")).collect()
    for s in sizes:
        got = sum(len(brute.words(r["text"])) for r in taken if r["source"] == s)
        assert abs(got - goal[s]) <= 0.06 * goal[s] + 60, (s, got, goal[s])
