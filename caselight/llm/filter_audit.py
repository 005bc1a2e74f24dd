"""What each filter removes in each order of filters: counts by coalition, potentials of the removal game, Shapley values.

Five filters judge each text once. Documents are counted by the set of filters they fail, so 32 numbers per part hold all
that any order of the filters can do: a coalition removes the documents that fail one of its members, and a step of an
order removes what its coalition removes beyond that of the filters before it. The potential of a coalition is
P(S) = (v(S) + sum over i in S of P(S without i)) / |S|; the Shapley value of a filter is P(all) - P(all without it).
The potentials are kept as whole numbers, times |S| factorial.

Results for odd input: a null text is empty (it fails A, and equals other empty texts); a null part is the empty string;
a null id is neither smaller nor larger than another, so such a row neither fails E nor makes others fail; rows that
repeat the smallest id of a text all pass E; an empty table gives no rows; several labels of one id count as one that has
each mark any of them has; other columns are not read.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, functions as F

from caselight.llm.common import let, words

LETTERS = "ABCDE"
ALL = 2 ** len(LETTERS) - 1


def failures(text: Column, repeated: Column) -> Column:
    """The filters a text fails, as a number with one bit each (A is 1, B is 2, ... E is 16)."""
    has = F.coalesce(text, F.lit(""))
    capitals = F.length(has) - F.length(F.regexp_replace(has, "[A-Z]", ""))

    def marks(found: Column) -> Column:
        n = F.size(found)
        return (F.when(n < 50, 1).otherwise(0)
                + F.when(100 * F.size(F.array_distinct(found)) < 65 * n, 2).otherwise(0))

    return (let(words(text), marks) + F.when(100 * capitals > 5 * F.length(has), 4).otherwise(0)
            + F.when(has.rlike("[#$%&*|]"), 8).otherwise(0) + F.when(repeated, 16).otherwise(0))


def by_failures(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source"
) -> DataFrame:
    """(part, fails, docs, good, toxic): documents of each part by the filters that they fail.

    Texts stay where they are: only digest, id and marks move, and they meet on (digest, smallest id of the digest), which
    spreads any group of copies.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    marked = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"), failures(F.col(text_col), F.lit(False)).alias("own"))
    first = docs.select(F.unhex(F.sha2(text, 256)).alias("digest"), F.col(id_col).alias("id")).groupBy("digest").agg(
        F.min("id").alias("id")).withColumn("first", F.lit(True))
    named = labels.groupBy(F.col("doc_id").alias("id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    joined = marked.join(first, ["digest", "id"], "left").join(named, "id", "left")
    repeated = F.col("id").isNotNull() & F.col("first").isNull()
    return joined.groupBy("part", (F.col("own") + F.when(repeated, 16).otherwise(0)).alias("fails")).agg(
        F.count(F.lit(1)).alias("docs"), F.sum(F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic"))


def coalitions(counts: DataFrame) -> DataFrame:
    """One row per part: total, and for each of the 32 coalitions (by number) how much it removes, good and toxic too."""
    sums = counts.groupBy("part").agg(
        F.sum("docs").alias("total"),
        *[F.array(*[F.sum(F.when(F.col("fails").bitwiseAND(s) != 0, F.col(name)).otherwise(0)) for s in range(ALL + 1)])
          .alias(f"{name}_removed") for name in ("docs", "good", "toxic")])
    return sums.withColumn("potential", potentials(F.col("docs_removed")))


def potentials(removed: Column) -> Column:
    """Potentials of all coalitions times the factorial of their size, each from those with one member less."""
    factorial = F.array(*[F.lit(n).cast("long") for n in (1, 1, 2, 6, 24)])

    def step(known: Column, s: Column) -> Column:
        own = F.element_at(factorial, F.bit_count(s)) * F.element_at(removed, s + 1)
        smaller = F.lit(0).cast("long")
        for i in range(len(LETTERS)):
            smaller += F.when(s.bitwiseAND(1 << i) != 0, F.element_at(known, s.bitwiseXOR(F.lit(1 << i)) + 1)).otherwise(0)
        return F.concat(known, F.array(own + smaller))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ALL)), F.array(F.lit(0).cast("long")), step)


def audit(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """One row per part, order of the filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    ``columns`` names id, text and part, see ``by_failures``. Each part gives 120 orders of 5 steps; ``shapley`` is the sum of
    what the step's filter removes over all 120 orders, which is 120 times its Shapley value.
    """
    orders = F.array(*[F.lit("".join(order)) for order in permutations(LETTERS)])
    table = coalitions(by_failures(docs, labels, **columns))

    def members(letters: Column) -> Column:
        held = F.lit(0)
        for i, letter in enumerate(LETTERS):
            held += F.when(letters.contains(letter), 1 << i).otherwise(0)
        return held

    steps = table.select("*", F.explode(orders).alias("filter_order")).select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(len(LETTERS)))).alias("step")).select(
        "*", members(F.expr("left(filter_order, step - 1)")).alias("before"),
        members(F.expr("substring(filter_order, step, 1)")).alias("own"))

    def at(name: str, coalition: Column) -> Column:
        return F.element_at(F.col(name), coalition + 1)

    after = F.col("before") + F.col("own")
    gone = lambda name: at(name, after) - at(name, F.col("before"))
    rest = F.lit(ALL) - F.col("own")
    return steps.select(
        "part", "filter_order", "step", (F.col("total") - at("docs_removed", after)).alias("kept"),
        gone("docs_removed").alias("removed"), (at("docs_removed", F.col("own")) - gone("docs_removed")).alias("redundant"),
        (at("docs_removed", F.lit(ALL)) - at("docs_removed", rest)).alias("unique_fails"),
        gone("good_removed").alias("good_lost"), gone("toxic_removed").alias("toxic_lost"),
        (at("potential", F.lit(ALL)) - len(LETTERS) * at("potential", rest)).alias("shapley"))
