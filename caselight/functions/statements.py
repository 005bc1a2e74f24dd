"""Safety tier of a SQL statement, as column expressions over the statement text.

The tier decides whether a proposed change is refused, shown to a person, or may run as a verified column rename. It
filters what people review; it does not prove that a statement is safe.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

REJECTED = "rejected"
NEEDS_APPROVAL = "needs_approval"
AUTO_EXECUTABLE = "auto_executable"

# The tables a proposed change may touch.
ALLOWED_TABLES = [
    "raw.case_reports",
    "monitoring.schema_snapshots",
    "monitoring.incident_reports",
    "monitoring.agent_approvals",
    "monitoring.pipeline_runs",
    "monitoring.row_count_baselines",
    "monitoring.freshness_checks",
]

# How a table reference and a plain column rename are spelled.
TABLE_PATTERN = (
    r"(?i)\b(?:FROM|UPDATE|INTO|TABLE|TRUNCATE)\s+"
    r'"?([a-zA-Z_][a-zA-Z0-9_]*)"?\s*\.\s*"?([a-zA-Z_][a-zA-Z0-9_]*)"?'
)
RENAME_PATTERN = r"(?i)^\s*ALTER\s+TABLE\s+\S+\s+RENAME\s+COLUMN\s+\S+\s+TO\s+\S+\s*;?\s*$"

# Quoted text, then comments; the first alternative that matches wins, so a dash pair inside quotes is no comment. Quoted
# are strings, strings with backslash escapes, names and dollar quotes. A comment matches only if no other starts inside it:
# where comments nest the engines differ, so what is left of them is refused.
# Possessive and unrolled: linear, and without a stack frame per character of a long literal.
_DOLLAR = r"(?<![\w$\x{80}-\x{ffff}])\$(?:[A-Za-z_]\w*+)?\$"
_LITERALS = r"""(?i:\be)'[^'\\]*+(?:(?:\\[\s\S]|'')[^'\\]*+)*+'|'[^']*+(?:''[^']*+)*+'|"[^"]*+(?:""[^"]*+)*+\""""
COMMENT = r"--[^\r\n]*+|/\*(?:[^*/]++|\*++[^*/]|/++[^*/])*+\*++/"
#: What must not be left once quoted text and comments are gone.
UNCLOSED = rf"""['"]|/\*|\*/|{_DOLLAR}"""


def quoted(group: int) -> str:
    """Pattern of quoted text; ``group`` is the number of the group that holds the tag of a dollar quote."""
    return rf"{_LITERALS}|({_DOLLAR})[\s\S]*?\{group}"


STATEMENT_WORDS = "SELECT|INSERT|UPDATE|DELETE|MERGE|CREATE|ALTER|DROP|UPSERT|REPLACE"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once per row, however often ``use`` mentions it.

    A plain column would be copied into every place that mentions it as soon as a filter is pushed below it; a lambda
    variable is not.
    """
    return F.transform(F.array(value), use)[0]


def mask(sql: Column) -> Column:
    """Each quoted text and comment replaced by one letter, so only real separators remain."""
    return F.regexp_replace(sql, f"{quoted(1)}|{COMMENT}", "q")


def bare(sql: Column) -> Column:
    """Text without comments and with quoted text emptied."""
    without_comments = F.regexp_replace(sql, f"({quoted(2)})|{COMMENT}", "$1 ")
    return F.regexp_replace(without_comments, quoted(1), "q")


def outline(text: Column) -> Column:
    """Struct (depth, lowest, has_where, word) of a ``bare`` text, from one pass over its parentheses and keywords.

    ``has_where`` and ``word`` (the first data keyword) look outside parentheses only, however deep these nest. The
    parentheses are balanced when ``depth``, what is open at the end, and ``lowest`` are both zero.
    """
    found = F.regexp_extract_all(text, F.lit(rf"(?i)[()]|\b(?:WHERE|{STATEMENT_WORDS})\b"), F.lit(0))
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("lowest"), F.lit(False).alias("has_where"),
                     F.lit("").alias("word"))

    def step(seen: Column, token: Column) -> Column:
        depth = seen["depth"] + F.when(token == "(", 1).when(token == ")", -1).otherwise(0)
        name = F.upper(token)
        plain = (seen["depth"] == 0) & ~token.isin("(", ")")
        return F.struct(
            depth.alias("depth"), F.least(seen["lowest"], depth).alias("lowest"),
            (seen["has_where"] | (plain & (name == "WHERE"))).alias("has_where"),
            F.when(plain & (seen["word"] == "") & (name != "WHERE"), name).otherwise(seen["word"]).alias("word"))

    return F.aggregate(found, start, step)


def statement_count(sql: Column) -> Column:
    """Number of non-blank parts between semicolons; a comment after the last semicolon counts as a part."""
    return F.size(F.filter(F.split(mask(sql), ";"), lambda part: part.rlike(r"\S")))


def statement_type(text: Column, word_outside: Column) -> Column:
    """First keyword of a ``bare`` text; for a WITH statement the first data keyword outside its CTEs."""
    first = F.upper(F.regexp_extract(text, r"^\s*([A-Za-z]+)", 1))
    word = F.when(first == "WITH", word_outside).otherwise(first)
    return F.when(word.isin(STATEMENT_WORDS.split("|")), word).otherwise("UNKNOWN")


def referenced_tables(sql: Column) -> Column:
    """Sorted schema-qualified names after FROM, UPDATE, INTO, TABLE and TRUNCATE, in lower case."""
    schemas = F.regexp_extract_all(sql, F.lit(TABLE_PATTERN), F.lit(1))
    tables = F.regexp_extract_all(sql, F.lit(TABLE_PATTERN), F.lit(2))
    return F.array_sort(F.array_distinct(F.zip_with(schemas, tables, lambda s, t: F.lower(F.concat_ws(".", s, t)))))


def verdict(
    text: Column, parts: Column, kind: Column, tables: Column, outside: Column, has_where: Column, closed: Column
) -> Column:
    """Struct of tier and reason; the first rule that applies decides."""

    def outcome(tier: str, reason: Column | str) -> Column:
        why = F.lit(reason) if isinstance(reason, str) else reason
        return F.struct(F.lit(tier).alias("tier"), why.alias("reason"))

    shouted = F.upper(text)
    rules = [
        (~text.rlike(r"\S"), outcome(REJECTED, "no statement")),
        (~closed, outcome(REJECTED, "quotes, comments or parentheses that do not close")),
        (parts != 1, outcome(REJECTED, F.concat(F.lit("expected one statement, found "), parts.cast("string")))),
        (F.size(tables) == 0, outcome(REJECTED, "no table could be identified")),
        (F.size(outside) > 0,
         outcome(REJECTED, F.concat(F.lit("tables outside the allow list: "), F.array_join(outside, ", ")))),
        (shouted.contains("DROP") | shouted.contains("TRUNCATE"), outcome(REJECTED, "drop or truncate")),
        ((kind == "DELETE") & ~has_where, outcome(REJECTED, "delete without where")),
        (kind == "DELETE", outcome(NEEDS_APPROVAL, "delete with where")),
        ((kind == "ALTER") & text.rlike(RENAME_PATTERN), outcome(AUTO_EXECUTABLE, "column rename")),
        (kind == "ALTER", outcome(NEEDS_APPROVAL, "alter other than a column rename")),
        (kind == "UPDATE", outcome(NEEDS_APPROVAL, "update")),
        (kind == "INSERT", outcome(NEEDS_APPROVAL, "insert")),
        (kind == "SELECT", outcome(REJECTED, "select fixes nothing")),
    ]
    result = outcome(REJECTED, F.concat(F.lit("unknown statement type "), kind))
    for condition, found in reversed(rules):
        result = F.when(condition, found).otherwise(result)
    return result


def classify(sql: Column, allowed: list[str] = ALLOWED_TABLES) -> Column:
    """Struct (tier, reason, statement_type, tables) of a statement."""
    names = F.array(*[F.lit(name) for name in allowed])

    def parse(text: Column) -> Column:
        return F.struct(
            text.alias("text"), bare(text).alias("bare"), statement_count(text).alias("parts"),
            referenced_tables(text).alias("tables"),
        )

    def analyse(parsed: Column) -> Column:
        closed = lambda seen: (seen["depth"] == 0) & (seen["lowest"] == 0) & ~parsed["bare"].rlike(UNCLOSED)
        return let(outline(parsed["bare"]), lambda seen: F.struct(
            parsed["text"].alias("text"), parsed["parts"].alias("parts"), parsed["tables"].alias("tables"),
            seen["has_where"].alias("has_where"), closed(seen).alias("closed"),
            statement_type(parsed["bare"], seen["word"]).alias("kind"),
            F.array_except(parsed["tables"], names).alias("outside"),
        ))

    def judge(found: Column) -> Column:
        typed = F.when(found["text"].rlike(r"\S") & (found["parts"] == 1), found["kind"])
        ruled = verdict(found["text"], found["parts"], found["kind"], found["tables"], found["outside"], found["has_where"],
                        found["closed"])
        return let(ruled, lambda result: F.struct(
            result["tier"].alias("tier"), result["reason"].alias("reason"), typed.alias("statement_type"),
            found["tables"].alias("tables"),
        ))

    return let(F.coalesce(sql, F.lit("")), lambda text: let(parse(text), lambda parsed: let(analyse(parsed), judge)))


def tier(sql: Column, allowed: list[str] = ALLOWED_TABLES) -> Column:
    """Tier only; null when there is no statement."""
    return F.when(F.coalesce(sql, F.lit("")) != "", classify(sql, allowed)["tier"])
