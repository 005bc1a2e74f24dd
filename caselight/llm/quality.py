"""Quality rules: fixed base rules, then fences taken from mergeable sketches of each language and source.

The sketch is a histogram with buckets of relative width: a count keeps its leading ``PRECISION`` bits, so a quantile is
exact below 128 and off by less than 1/64 above. Two sketches merge by adding counts, in any order, so the thresholds do
not depend on how Spark dealt the rows. All of it is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from caselight.llm.common import SPACE, let, stored, words

PRECISION = 7
WINDOW = 8
#: Repeated words from which a text is held to the tighter fence on repeats; a phrase or two in a short text stay below.
LEAST_REPEATS = 4 * WINDOW
#: Scaled measures: name -> (expression, whether a low value is bad too, slack added to each fence).
MEASURES = {
    "word_length": ("100 * word_chars div n_words", True, 100),
    "symbols": ("1000 * n_symbols div n_words", False, 100),
    "dup_lines": ("1000 * n_dup_lines div n_words", False, 50),
    "repeats": ("1000 * n_repeat_words div n_words", False, 290),
    "long_repeats": (f"if(n_repeat_words < {LEAST_REPEATS}, 0, 1000 * n_repeat_words div n_words)", False, 150),
    "runs": ("1000 * n_run_words div n_words", False, 100),
}


def repeat_words(tokens: Column) -> Column:
    """How many words lie in windows of eight words that occur twice or more in the text.

    Windows are compared by 64-bit hashes. A text without a repeated window ends after the distinct count; for the others
    (hash, position) pairs are sorted and the covered words summed over the positions of the repeated ones.
    """
    def doubled(hashes: Column, step: int) -> Column:
        n = F.size(hashes) - step
        return F.zip_with(F.slice(hashes, 1, F.greatest(n, F.lit(0))),
                          F.slice(hashes, step + 1, F.greatest(n, F.lit(0))), lambda a, b: F.xxhash64(a, b))

    def covered(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def positions(s: Column) -> Column:
            none = F.array(F.lit(None).cast(
                "struct<h:bigint,i:int>"))
            before = F.concat(none, F.slice(s, 1, F.size(s) - 1))
            after = F.concat(F.slice(s, 2, F.size(s)), none)
            flags = F.arrays_zip(s.alias("s"), before.alias("b"), after.alias("a"))
            kept = F.filter(flags, lambda x: F.coalesce(x["s"]["h"] == x["b"]["h"], F.lit(False))
                            | F.coalesce(x["s"]["h"] == x["a"]["h"], F.lit(False)))
            return F.sort_array(F.transform(kept, lambda x: x["s"]["i"]))

        def total(p: Column) -> Column:
            gaps = F.zip_with(p, F.slice(p, 2, F.size(p)),
                              lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))))
            return F.aggregate(gaps, F.lit(0), lambda acc, g: acc + g)

        return let(let(pairs, positions), total)

    start = F.transform(tokens, lambda w: F.xxhash64(w))
    windows = let(let(let(start, lambda h: doubled(h, 1)), lambda h: doubled(h, 2)), lambda h: doubled(h, 4))
    return F.when(F.size(tokens) <= WINDOW, F.lit(0)).otherwise(let(
        windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h))
    )).cast("long")


def run_words(tokens: Column) -> Column:
    """How many words equal the word before."""
    pairs = F.zip_with(tokens, F.slice(tokens, F.lit(2), F.greatest(F.size(tokens), F.lit(0))), lambda a, b: a.eqNullSafe(b))
    return F.size(F.filter(pairs, lambda x: x)).cast("long")


def measured(docs: DataFrame, text_col: str = "text", name: str = "__quality") -> DataFrame:
    """Append one struct with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and n_run_words."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    bare = F.regexp_replace(text, SPACE + "+", "")

    def counts(tokens: Column) -> Column:
        return F.struct(
            F.size(tokens).cast("long").alias("n_words"),
            F.length(bare).cast("long").alias("word_chars"),
            (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            repeat_words(tokens).alias("n_repeat_words"),
            run_words(tokens).alias("n_run_words"))

    return docs.withColumn(name, let(words(F.col(text_col)), counts))


def base_failed(min_words: int, max_repeat_percent: int) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))


def fences(rows: DataFrame, spread: float = 6.0, min_docs: int = 100) -> DataFrame:
    """Lowest and highest accepted value of each measure for each language and source.

    ``rows`` has lang, source and the base counts of documents that passed the base rules. A fence lies ``spread``
    quartile distances plus the slack of the measure beyond the quartile. Quartiles are those of the group's sketch with
    the language's shares added as ``min_docs`` further documents, and the language's has those of all documents added in
    the same way: one rule at every size, in which the wider sketches fade as the group grows.
    """
    stack = ", ".join(f"'{name}', cast({expression} as bigint)" for name, (expression, _, _) in MEASURES.items())
    values = rows.select("lang", "source", F.expr(f"stack({len(MEASURES)}, {stack}) as (measure, v)"))
    shift = f"greatest(length(bin(v)) - {PRECISION}, 0)"
    sketch = (values.withColumn("bucket", F.expr(f"shiftleft(shiftright(v, {shift}), {shift})"))
              .groupBy("lang", "source", "measure", "bucket").agg(F.count("*").alias("n")))
    by_lang = sketch.groupBy("lang", "measure", "bucket").agg(F.sum("n").alias("n"))
    by_all = by_lang.groupBy("measure", "bucket").agg(F.sum("n").alias("n"))

    def listed(merged: DataFrame, keys: list[str]) -> DataFrame:
        return merged.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("bucket", "n"))).alias("part"),
                                         F.sum("n").alias("docs"))

    def faded(part: Column, wider: Column) -> Column:
        """``part`` with the shares of ``wider`` added as ``min_docs`` further documents."""
        return F.concat(F.transform(part, lambda x: F.struct(x["bucket"].alias("bucket"), x["n"].cast("double").alias("n"))),
                        F.transform(wider, lambda x: F.struct(x["bucket"].alias("bucket"), (min_docs * x["share"]).alias("n"))))

    def shares(part: Column, docs: Column) -> Column:
        return F.transform(part, lambda x: F.struct(x["bucket"].alias("bucket"), (x["n"] / docs).alias("share")))

    def quantile(part: Column, docs: Column, quarters: int) -> Column:
        start = F.struct(F.lit(0.0).alias("upto"), F.lit(None).cast("bigint").alias("at"))
        return F.aggregate(part, start, lambda acc, x: F.struct(
            (acc["upto"] + x["n"]).alias("upto"),
            F.coalesce(acc["at"], F.when(4 * (acc["upto"] + x["n"]) >= quarters * docs, x["bucket"])).alias("at")))["at"]

    every = listed(by_all, ["measure"]).select("measure", shares(F.col("part"), F.col("docs")).alias("wider"))
    lang = listed(by_lang, ["lang", "measure"]).join(every, "measure").select(
        "lang", "measure", shares(faded(F.col("part"), F.col("wider")), F.col("docs") + min_docs).alias("wider")).alias("lang")
    own = listed(sketch, ["lang", "source", "measure"]).alias("own")
    mixed = own.join(lang, F.col("own.lang").eqNullSafe(F.col("lang.lang")) & (F.col("own.measure") == F.col("lang.measure"))).select(
        "own.lang", "own.source", "own.measure", (F.col("docs") + min_docs).alias("docs"),
        F.sort_array(faded(F.col("part"), F.col("wider"))).alias("part"))
    quart = mixed.select("lang", "source", "measure", quantile(F.col("part"), F.col("docs"), 1).alias("q1"),
                         quantile(F.col("part"), F.col("docs"), 3).alias("q3"))
    sides = []
    for name, (_, low_counts, slack) in MEASURES.items():
        here = F.col("measure") == name
        reach = spread * (F.col("q3") - F.col("q1")) + slack
        sides.append(F.max(F.when(here, F.col("q3") + reach)).alias(f"max_{name}"))
        if low_counts:
            sides.append(F.max(F.when(here, F.col("q1") - reach)).alias(f"min_{name}"))
    return quart.groupBy("lang", "source").agg(*sides)


def within_fences(limits: Column) -> Column:
    """Whether the counts of a row lie within the fences of its group; true where a group has no fence."""
    inside = F.lit(True)
    for name, (expression, low_counts, _) in MEASURES.items():
        value = F.expr(expression)
        inside = inside & F.coalesce(value <= limits[f"max_{name}"], F.lit(True))
        if low_counts:
            inside = inside & F.coalesce(value >= limits[f"min_{name}"], F.lit(True))
    return inside


def _judged(rows: DataFrame, limits: DataFrame) -> DataFrame:
    """Rows with id, lang, source, base counts and base_failed: add the verdict."""
    limits = limits.select(F.col("lang").alias("l"), F.col("source").alias("s"), F.struct(
        *[c for c in limits.columns if c not in ("lang", "source")]).alias("limits"))
    joined = rows.join(limits, rows["lang"].eqNullSafe(limits["l"]) & rows["source"].eqNullSafe(limits["s"]), "left")
    return joined.withColumn(
        "kept", F.when(F.col("base_failed"), F.lit(False)).otherwise(within_fences(F.col("limits")))).drop("l", "s", "limits")


def _counted(docs: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str, min_words: int,
             max_repeat_percent: int, *more: Column) -> DataFrame:
    counts = measured(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                                  F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), *more))
    names = [c for c in counts.columns if c not in ("text", "__quality")]
    return counts.select(*names, "__quality.*").withColumn("base_failed", base_failed(min_words, max_repeat_percent))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source", min_words: int = 20, max_repeat_percent: int = 30, spread: float = 6.0,
          min_docs: int = 100) -> DataFrame:
    """One row per input row: id, counts, base_failed, kept, n_run_words.

    Null or blank text has no words and fails the base rules. Null languages and sources form groups of their own.
    Repeated rows are judged alike, each counting in its sketch; other columns are not read; an empty table gives none.
    """
    rows = stored(_counted(docs, id_col, text_col, lang_col, source_col, min_words, max_repeat_percent), "quality")
    judged = _judged(rows, fences(rows.filter(~F.col("base_failed")), spread, min_docs))
    return judged.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "kept", "n_run_words")


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
              source_col: str = "source", min_words: int = 20, max_repeat_percent: int = 30, spread: float = 6.0,
              min_docs: int = 100) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all their columns.

    Counts are taken once to find the fences and once more to filter: that is cheaper than moving the texts.
    """
    rows = stored(_counted(docs, id_col, text_col, lang_col, source_col, min_words, max_repeat_percent), "quality")
    limits = stored(fences(rows.filter(~F.col("base_failed")), spread, min_docs), "fences")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")
    again = _counted(docs, id_col, text_col, lang_col, source_col, min_words, max_repeat_percent, whole)
    return _judged(again, limits).filter("kept").select("whole.*")
