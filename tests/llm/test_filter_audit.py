"""The audit against a simulation of every order of the filters, and the potentials against sums over orders."""

import random
from itertools import permutations
from math import factorial

from pyspark.sql import functions as F

from caselight.llm import filter_audit
from tests.llm import brute

COLUMNS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def fails(rows):
    """rows: (id, text, part); the filters that each row fails."""
    out = []
    for i, text, _ in rows:
        text = text or ""
        w = brute.words(text)
        f = "A" if len(w) < 50 else ""
        f += "B" if 100 * len(set(w)) < 65 * len(w) else ""
        f += "C" if 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text) else ""
        f += "D" if any(c in "#$%&*|" for c in text) else ""
        f += "E" if i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in rows) else ""
        out.append(f)
    return out


def simulate(rows, marks):
    """Apply the filters in all orders, one document at a time."""
    failed, out = fails(rows), []
    for part in {p or "" for _, _, p in rows}:
        mine = [(i, f) for (i, _, p), f in zip(rows, failed) if (p or "") == part]
        removed_in_all = {x: 0 for x in "ABCDE"}
        steps = []
        for order in permutations("ABCDE"):
            left = mine
            for step, x in enumerate(order, 1):
                gone = [(i, f) for i, f in left if x in f]
                left = [(i, f) for i, f in left if x not in f]
                removed_in_all[x] += len(gone)
                steps.append((part, "".join(order), step, len(left), len(gone), sum(x in f for _, f in mine) - len(gone),
                              sum(f == x for _, f in mine), sum((i, "good") in marks for i, _ in gone),
                              sum((i, "toxic") in marks for i, _ in gone), x))
        out += [row[:-1] + (removed_in_all[row[-1]],) for row in steps]
    return sorted(out)


def audited(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def test_messy_documents(spark, messy, messy_rows):
    rng = random.Random(2)
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in [*range(60), *range(10), None]]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    marks = {(i, "good") for i, q, _ in labels if q == 1 and i is not None}
    marks |= {(i, "toxic") for i, _, t in labels if t == 1 and i is not None}
    rows = [(r[0], r[1], r[3]) for r in messy_rows]
    assert audited(filter_audit.audit(messy, table)) == simulate(rows, marks)


def test_all_failure_sets_and_ties(spark):
    rng = random.Random(4)
    long = " ".join(f"w{k}" for k in range(60))
    texts = ["", None, long, long + " #", "A" * 40, "a a a", long.upper(), (long + " ") * 2, "x " * 200 + "#", "B $"]
    rows = [(rng.choice([None, *range(40)]), rng.choice(texts), rng.choice(["p", "q", "", None])) for _ in range(150)]
    docs = spark.createDataFrame([(*r, "x", 1, True) for r in rows],
                                 "doc_id long, text string, source string, part string, fails int, first boolean").repartition(4)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audited(filter_audit.audit(docs, none)) == simulate(rows, set())


def test_no_documents(spark, nothing):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(nothing, none).count() == 0


def test_potentials_add_up(spark):
    rng = random.Random(6)
    removed = [0] + [rng.randrange(1000) for _ in range(31)]
    df = spark.createDataFrame([(removed,)], "v array<bigint>")
    found = df.select(filter_audit.potentials(F.col("v")).alias("p")).first()["p"]
    size = lambda s: bin(s).count("1")
    for s in range(1, 32):  # the marginal potentials of a coalition's members sum to what it removes
        members = [i for i in range(5) if s >> i & 1]
        assert sum(found[s] - size(s) * found[s ^ (1 << i)] for i in members) == factorial(size(s)) * removed[s]


def test_copies_do_not_meet_in_one_task(spark, messy):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    plan = filter_audit.by_failures(messy, none)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "collect" not in plan
