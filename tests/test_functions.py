import datetime as dt
import random
import re

from pyspark.sql import functions as F

from caselight.functions import codes, labels, logs, measures, statements
from caselight.operators.audit import audit
from tests.helpers import column

CODES = [None, "", " ", "1", " 1 ", "1.0", "NaN", "-999", "2"]


def test_flags(spark):
    assert column(spark, "c string", CODES, codes.flag(F.col("c"))) == [
        None, None, None, True, True, False, False, False, False]
    assert column(spark, "c string", CODES, codes.strict_flag(F.col("c"))) == [
        False, False, False, True, True, False, False, False, False]


def test_normalized_codes(spark):
    assert column(spark, "c string", CODES, codes.normalize_code(F.col("c"))) == [
        None, None, None, "1", "1", "1", None, "-999", "2"]


def test_days(spark):
    values = ["20240229", " 20240229 ", "", None, "20241345", "2024010", "20230229"]
    day = dt.date(2024, 2, 29)
    assert column(spark, "c string", values, codes.parse_day(F.col("c"))) == [day, day, None, None, None, None, None]


def test_ages_ignore_nan(spark):
    df = spark.createDataFrame([(float("nan"),), (2.0,), (None,)], "a double")
    assert df.agg(F.avg(codes.age(F.col("a"))).cast("double")).first()[0] == 2.0
    assert column(spark, "c string", ["41", "NaN", "x", None], codes.age(F.col("c")).cast("double")) == [41.0, None, None, None]


def test_deviation(spark):
    df = spark.createDataFrame([(0, 0), (5, 0), (5, 10), (15, 10), (5, None)], "c bigint, b bigint")
    got = [r[0] for r in df.select(measures.deviation(F.col("c"), F.col("b"))).collect()]
    assert got == [0.0, 1.0, 0.5, 0.5, None]


def test_percent_of_nothing(spark):
    df = spark.createDataFrame([(1, 4), (1, 0)], "a int, b int")
    assert [r[0] for r in df.select(measures.percent(F.col("a"), F.col("b"))).collect()] == [25.0, None]


def test_local_time_follows_daylight_saving(spark):
    values = [dt.datetime(2024, 7, 1, 12), dt.datetime(2024, 1, 1, 12), None]
    assert column(spark, "t timestamp_ntz", values, measures.local_time(F.col("t"))) == [
        "2024-07-01 08:00 AM", "2024-01-01 07:00 AM", None]


def test_durations(spark):
    values = [None, 0.9, 59.0, 60.0, 3601.5]
    assert column(spark, "s double", values, labels.duration_label(F.col("s"))) == ["—", "0s", "59s", "1m 00s", "60m 01s"]


def test_shorten(spark):
    values = ["a" * 60, "a" * 61, None]
    assert column(spark, "s string", values, labels.shorten(F.col("s"), 60, 57)) == ["a" * 60, "a" * 57 + "…", None]


def test_labels(spark):
    values = ["auto_approved", "pending", "odd", "", None]
    assert column(spark, "s string", values, labels.decision_label(F.col("s"))) == [
        "Auto-Resolved", "Pending", "odd", "Unknown", "Unknown"]
    kinds = ["data_corruption", "schema_drift", "volume_anomaly", "data_quality", "freshness", "upstream_failure", "x", None]
    assert column(spark, "s string", kinds, labels.severity(F.col("s"))) == ["P0", "P1", "P1", "P2", "P2", "P3", "P3", "P3"]


def test_run_labels_have_precedence(spark):
    df = spark.createDataFrame(
        [(True, True, False), (False, True, False), (False, False, True), (False, False, False)],
        "h boolean, f boolean, s boolean")
    got = [r[0] for r in df.select(labels.run_label(F.col("h"), F.col("f"), F.col("s"))).collect()]
    assert got == ["Healed by AI", "Failed", "Success", "Running"]


def test_error_messages(spark):
    trace = "Traceback (most recent call last):\n  File x\n\nValueError: row count deviated\t\n \n"
    values = [trace, "  plain text \n", "\n \n", "two\nlines", trace.replace("\n", "\r\n"), None]
    assert column(spark, "s string", values, logs.error_message(F.col("s"))) == [
        "ValueError: row count deviated", "plain text", "", "two\nlines", "ValueError: row count deviated", None]


def test_hints_first_match_wins(spark):
    cases = {
        'column "x" does not exist': "schema_drift",
        "Schema Validation FAILED": "schema_drift",
        "S3 object raw/x does not exist": "upstream_failure",
        "read timeout": "upstream_failure",
        "Deleted 12 rows": "volume_anomaly",
        "value is NULL": "data_quality",
        "row count is null": "volume_anomaly",
        "all good": None,
    }
    assert column(spark, "s string", list(cases), logs.error_type_hint(F.col("s"))) == list(cases.values())


UNCLOSED = "quotes, comments or parentheses that do not close"
TIERS = [
    (None, "rejected", "no statement", None),
    (" \n", "rejected", "no statement", None),
    ("UPDATE raw.case_reports SET a = 1; SELECT 1", "rejected", "expected one statement, found 2", None),
    ("UPDATE raw.case_reports SET a = 1; -- note", "rejected", "expected one statement, found 2", None),
    ("UPDATE raw.case_reports SET a = ';'", "needs_approval", "update", "UPDATE"),
    ("UPDATE raw.case_reports SET a = '--;' ;", "needs_approval", "update", "UPDATE"),
    ('UPDATE raw.case_reports SET "a;b" = 1', "needs_approval", "update", "UPDATE"),
    ("UPDATE reports SET a = 1", "rejected", "no table could be identified", "UPDATE"),
    ("UPDATE raw.other SET a = 1", "rejected", "tables outside the allow list: raw.other", "UPDATE"),
    ("INSERT INTO monitoring.pipeline_runs SELECT * FROM a.b", "rejected", "tables outside the allow list: a.b", "INSERT"),
    ("ALTER TABLE raw.case_reports DROP COLUMN x", "rejected", "drop or truncate", "ALTER"),
    ("UPDATE raw.case_reports SET dropoff = 1", "rejected", "drop or truncate", "UPDATE"),
    ("DELETE FROM raw.case_reports", "rejected", "delete without where", "DELETE"),
    ("DELETE FROM raw.case_reports -- where", "rejected", "delete without where", "DELETE"),
    ("delete from RAW.CASE_REPORTS where x is null", "needs_approval", "delete with where", "DELETE"),
    ("ALTER TABLE raw.case_reports RENAME COLUMN a TO b ;", "auto_executable", "column rename", "ALTER"),
    ("ALTER TABLE raw.case_reports RENAME TO b", "needs_approval", "alter other than a column rename", "ALTER"),
    ("INSERT INTO raw.case_reports VALUES (1)", "needs_approval", "insert", "INSERT"),
    ("SELECT * FROM raw.case_reports", "rejected", "select fixes nothing", "SELECT"),
    ("WITH x AS (SELECT 1 FROM raw.case_reports) DELETE FROM raw.case_reports", "rejected", "delete without where", "DELETE"),
    ("WITH x AS (SELECT 1 FROM raw.case_reports) UPDATE raw.case_reports SET a = 1", "needs_approval", "update", "UPDATE"),
    ("DELETE FROM raw.case_reports /* /* */ WHERE 1=1 -- */", "rejected", UNCLOSED, "DELETE"),
    ("DELETE FROM raw.case_reports $$ WHERE 1=1 $$", "rejected", "delete without where", "DELETE"),
    ("DELETE FROM raw.case_reports $a$ $b$ $a$ WHERE a$b$ = $b$ c", "rejected", UNCLOSED, "DELETE"),
    ("DELETE FROM raw.case_reports WHERE a = $1", "needs_approval", "delete with where", "DELETE"),
    ("DELETE FROM raw.case_reports WHERE a = E'\\'' OR b = ''", "needs_approval", "delete with where", "DELETE"),
    ("UPDATE raw.case_reports SET a = E'\\'; DELETE FROM raw.case_reports --'", "needs_approval", "update", "UPDATE"),
    ("GRANT ALL ON TABLE raw.case_reports TO me", "rejected", "unknown statement type UNKNOWN", "UNKNOWN"),
    ("/* ; */ UPDATE \"raw\".\"case_reports\" SET a = 1", "needs_approval", "update", "UPDATE"),
]


def test_long_and_deep_statements(spark):
    deep = "DELETE FROM raw.case_reports USING (SELECT 1 AS a WHERE %s1 = 1%s) q"
    texts = [deep % ("(" * n, ")" * n) for n in (0, 7, 8, 50, 5000)]
    texts += ["UPDATE raw.case_reports SET a = '%s' WHERE b = 1" % ("x''y" * 250_000), '-- "' + "z" * 1_000_000 + "\nSELECT 1",
              "DELETE FROM raw.case_reports WHERE a IN (1", "DELETE FROM raw.case_reports) WHERE (a = 1", "UPDATE raw.case_reports SET a = 'b"]
    got = column(spark, "s string", texts, statements.classify(F.col("s")))
    assert [r["reason"] for r in got[:5]] == ["delete without where"] * 5
    assert [r["reason"] for r in got[5:7]] == ["update", "no table could be identified"]
    assert [r["reason"] for r in got[7:]] == [UNCLOSED] * 3


def test_statement_tiers(spark):
    got = column(spark, "s string", [t[0] for t in TIERS], statements.classify(F.col("s")))
    assert [(r["tier"], r["reason"], r["statement_type"]) for r in got] == [t[1:] for t in TIERS]


def lexed(sql):
    """What a database sees of a statement: the text outside quotes, comments and parentheses; None if something stays open.

    One character at a time, with comments that nest, as PostgreSQL does it.
    """
    i, out, depth = 0, "", 0
    while i < len(sql):
        if sql.startswith("--", i):
            while i < len(sql) and sql[i] not in "\r\n":
                i += 1
        elif sql.startswith("/*", i):
            level, i = 1, i + 2
            while level:
                if i >= len(sql):
                    return None
                step = {"/*": 1, "*/": -1}.get(sql[i:i + 2], 0)
                level, i = level + step, i + (2 if step else 1)
            out += " "
        elif sql[i] in "'\"":
            mark, escapes = sql[i], sql[i] == "'" and out[-1:] in ("e", "E") and not out[-2:-1].isalnum()
            i += 1
            while True:
                if i >= len(sql):
                    return None
                if escapes and sql[i] == "\\":
                    i += 2
                elif sql[i:i + 2] == mark * 2:
                    i += 2
                elif sql[i] == mark:
                    break
                else:
                    i += 1
            out, i = out + "q", i + 1
        elif (tag := re.match(r"\$([A-Za-z_]\w*)?\$", sql[i:])) and not re.search(r"[\w$]$", out):
            end = sql.find(tag.group(), i + tag.end())
            if end < 0:
                return None
            out, i = out + "q", end + tag.end()
        else:
            depth += {"(": 1, ")": -1}.get(sql[i], 0)
            if depth < 0:
                return None
            out += sql[i] if depth == 0 else " "
            i += 1
    return out if depth == 0 else None


def test_no_where_is_made_up(spark):
    """Whatever quotes and comments surround it, a DELETE passes for review only if the database sees its WHERE."""
    rng = random.Random(12)
    parts = ["/*", "*/", "/* /*", "'", "''", '"', "$$", "$q$", "--", "\n", " WHERE 1=1 ", "(", ")", " x ", "E'", "\\", "*", "/", "e", "$"]
    texts = ["DELETE FROM raw.case_reports " + "".join(rng.choice(parts) for _ in range(rng.randrange(1, 9))) for _ in range(20_000)]
    texts += ["DELETE FROM raw.case_reports /* /* */ WHERE 1=1 -- */", "DELETE FROM raw.case_reports /* /* */ */ WHERE 1=1"]
    got = column(spark, "s string", texts, statements.classify(F.col("s")))
    passed = [t for t, r in zip(texts, got) if r["tier"] != "rejected"]
    assert len(passed) > 500
    for text in passed:
        seen = lexed(text)
        assert seen is not None and re.search(r"\bWHERE\b", seen), text


def test_each_text_is_judged_once(spark):
    df = spark.createDataFrame([(i, sql) for i, sql in enumerate(["", None, "SELECT 1"] * 5 + [t[0] for t in TIERS])], "id long, sql string")
    got = audit(df).orderBy("id").collect()
    assert [(r["audit"]["tier"], r["audit"]["reason"], r["audit"]["statement_type"]) for r in got[15:]] == [t[1:] for t in TIERS]
    assert [r["audit"]["reason"] for r in got[:3]] == ["no statement"] * 2 + ["no table could be identified"]
    plan = audit(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Join") < plan.index("HashAggregate")  # classified after the different texts were merged


def test_allow_list_is_a_parameter(spark):
    sql = "UPDATE raw.other SET a = 1"
    assert column(spark, "s string", [sql, None], statements.tier(F.col("s"), ["raw.other"])) == ["needs_approval", None]
