"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score. DataFrame operations.

Positions come from cutting a text at the matches of a pattern: the lengths of the pieces between and of the matches
add up to code point offsets. They are added up in chunks of matches, then over the chunks, because a fold that appends to
one long array copies it at every step. Words nearby are looked up in blocks of the text, because a substring counts code
points from the start of its text. Patterns are possessive, so each is linear in the text and needs no deep stack.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from caselight.llm.common import let

#: A proposed span is accepted at this score.
ACCEPT = 0.5
#: Code points before and after a span that are searched for context words.
NEAR = 40
#: Matches whose lengths are added up by one fold; code points of one block of a text.
CHUNK, BLOCK = 256, 4096


@dataclass(frozen=True)
class Kind:
    """``needs`` is a pattern that a text must contain; ``base`` kinds are accepted whatever their score."""

    name: str
    pattern: str
    needs: str
    score: float = 1.0
    base: bool = False
    check: str = ""
    context: str = ""
    lift: float = 0.0
    against: str = ""


#: Where a match may start: not inside a run of its own characters unless the match before ended there.
def _edge(chars: str) -> str:
    return rf"(?:\G|(?<![{chars}]))"


LOCAL = "A-Za-z0-9._%+-"
KINDS = (
    Kind("email", _edge(LOCAL) + rf"[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", base=True),
    Kind("ip", _edge("0-9") + r"[0-9]++(?:\.[0-9]++){3}+", ".", base=True, check="octets"),
    # Only runs of the right length: a run goes on while digits follow, with a blank or hyphen between two of them at most.
    Kind("card", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])", "", base=True, check="luhn"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", base=True, check="phone"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3}+)?+(?![A-Za-z0-9])", "",
         score=0.4, check="mod97", lift=0.2, context="iban|account|konto|compte|cuenta|bank|banque|banco",
         against="isbn|serial|part no|order no|tracking"),
    Kind("ssn", r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])", "-", score=0.3, check="ssn",
         lift=0.0, context="ssn|social security|sozialversicherung|s[ée]curit[ée] sociale|seguro social",
         against="isbn|order|invoice|part no"),
)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(match: Column) -> Column:
    """13 to 19 digits whose Luhn sum is a multiple of ten."""
    digits = F.reverse(_digits(match))
    values = F.transform(F.split(digits, ""), lambda c, i: let(
        (F.ascii(c) - 48) * F.when(i % 2 == 1, 2).otherwise(1), lambda v: F.when(v > 9, v - 9).otherwise(v)))
    total = F.aggregate(values, F.lit(0), lambda acc, v: acc + v)
    return F.length(digits).between(13, 19) & (F.when(F.length(digits).between(13, 19), total) % 10 == 0)


def mod97(match: Column) -> Column:
    """15 to 34 characters; the first four moved behind the rest, letters as 10 to 35, remainder 1."""
    bare = F.replace(match, F.lit(" "), F.lit(""))
    moved = F.concat(F.substring(bare, 5, 34), F.substring(bare, 1, 4))

    def step(acc: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code >= 65, (acc * 100 + code - 55) % 97).otherwise((acc * 10 + code - 48) % 97)

    rest = F.aggregate(F.split(moved, ""), F.lit(0), step)
    return F.length(bare).between(15, 34) & (rest == 1)


def passes(kind: Kind, match: Column) -> Column:
    if kind.check == "octets":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
        return match.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind.check == "luhn":
        return luhn(match)
    if kind.check == "phone":
        return F.length(_digits(match)).between(9, 15)
    if kind.check == "mod97":
        return mod97(match)
    if kind.check == "ssn":
        return ~match.rlike("^(?:000|666|9)") & ~match.rlike("-00-|-0000$")
    return F.lit(True)


def spans_of(kind: Kind, text: Column) -> Column:
    """Accepted spans of one kind as an array of (start, end, score); code points, end exclusive."""
    empty = F.array().cast("array<struct<start:int,end:int,score:double>>")

    def located(matches: Column) -> Column:
        """(start, end, text) of each match: places within its chunk, and the chunks one after the other."""
        pieces = F.split(text, kind.pattern, -1)
        zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,text:string>>").alias("out"))

        def step(acc: Column, pair: Column) -> Column:
            start = acc["at"] + F.length(pair["piece"])
            end = start + F.length(pair["match"])
            span = F.struct(start.alias("start"), end.alias("end"), pair["match"].alias("text"))
            return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

        def placed(chunks: Column) -> Column:
            starts = F.aggregate(chunks, F.array(F.lit(0)), lambda acc, c: F.concat(
                acc, F.array(F.element_at(acc, -1) + c["at"])))
            moved = F.zip_with(chunks, F.slice(starts, F.lit(1), F.size(chunks)), lambda c, s: F.transform(c["out"], lambda x: F.struct(
                (x["start"] + s).alias("start"), (x["end"] + s).alias("end"), x["text"].alias("text"))))
            return F.flatten(moved)

        pairs = F.slice(F.zip_with(matches, pieces, lambda m, p: F.struct(m.alias("match"), p.alias("piece"))),
                        F.lit(1), F.size(matches))
        return let(pairs, lambda all_pairs: let(
            F.transform(F.sequence(F.lit(0), F.floor((F.size(all_pairs) - 1) / CHUNK).cast("int")),
                        lambda c: F.aggregate(F.slice(all_pairs, c * CHUNK + 1, F.lit(CHUNK)), zero, step)), placed))

    def scored(blocks: Column, span: Column) -> Column:
        score = F.lit(kind.score) + F.lit(kind.lift)
        if kind.context:
            def part(start: Column, length: Column) -> Column:
                """``length`` code points from ``start``, at most a block of them."""
                at = F.floor(start / BLOCK).cast("int")
                here = F.concat(F.get(blocks, at), F.coalesce(F.get(blocks, at + 1), F.lit("")))
                return F.coalesce(F.substring(here, start - at * BLOCK + 1, length), F.lit(""))

            first = F.greatest(span["start"] - NEAR, F.lit(0))
            near = F.lower(F.concat(part(first, span["start"] - first), F.lit(" "), part(span["end"], F.lit(NEAR))))
            score = score + F.when(near.rlike(kind.context), 0.4).otherwise(0.0)
            if kind.against:
                score = score - F.when(near.rlike(kind.against), 0.3).otherwise(0.0)
        return F.struct(span["start"].alias("start"), span["end"].alias("end"), score.alias("score"))

    def judged(matches: Column) -> Column:
        valid = F.filter(located(matches), lambda s: passes(kind, s["text"]))
        cut = F.transform(F.sequence(F.lit(0), F.floor(F.length(text) / BLOCK).cast("int")),
                          lambda b: F.substring(text, b * BLOCK + 1, F.lit(BLOCK)))
        return let(valid, lambda spans: F.when(F.size(spans) == 0, empty).otherwise(let(
            cut if kind.context else F.array().cast("array<string>"),
            lambda blocks: F.filter(F.transform(spans, lambda s: scored(blocks, s)), lambda s: s["score"] >= ACCEPT))))

    found = let(F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)),
                lambda m: F.when(F.size(m) == 0, empty).otherwise(judged(m)))
    return F.when(F.contains(text, F.lit(kind.needs)), found).otherwise(empty) if kind.needs else found


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, a count for each base kind, base_sha256, spans, and scored_spans with the scores.

    Base kinds (email, ip, card, phone) are the leftmost matches that do not overlap and pass their check. The method
    adds bank account numbers (mod 97), unless words nearby speak of another number, and social security numbers, only beside
    a word that speaks of them. Null and empty texts have no spans; an empty table gives no rows. Long texts are linear in
    their length and matches. Rows are handled one by one, repeated ones too, without a shuffle; other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    # One projection for each kind: an array is computed once although it is used several times.
    for kind in KINDS:
        rows = rows.withColumn(kind.name, spans_of(kind, F.col("text")))

    def each(name: str, body) -> Column:
        return F.transform(F.col(name), lambda s: body(name, s))

    def written(kinds: list[str]) -> Column:
        lists = [each(k, lambda name, s: F.concat(F.lit(name + ":"), s["start"].cast("string"), F.lit(":"),
                                                  s["end"].cast("string"))) for k in kinds]
        return F.array_join(F.concat(*lists), ",")

    base = [k.name for k in KINDS if k.base]
    scored = F.concat(*[each(k.name, lambda name, s: F.struct(
        F.lit(name).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["score"].alias("score")))
        for k in KINDS])
    return rows.select(
        F.col("id").alias(id_col), *[F.size(k).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(written(base), 256).alias("base_sha256"), written([k.name for k in KINDS]).alias("spans"),
        scored.alias("scored_spans"))
