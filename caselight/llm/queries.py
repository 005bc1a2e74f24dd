"""One query for each operator over its whole table, and the SQL that checks those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from caselight.llm import (
    bpe, exact, filter_audit, fmindex, jaccard, mixing, phrases, pii, quality, suffix, url_filters, warc, wrappers,
)
from caselight.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

#: host, path, verdict.
URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
             ("org", "/fr/", "allow"))


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Where the installed vocabulary lies; the same place on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filters.judge_urls(table(spark, sf_dir, "pages"), rules)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_groups(table(spark, sf_dir, "documents"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), vocabulary(), ids=False, decoded=False, digests=True)


def op6_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(table(spark, sf_dir, "documents"))


def op7_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fmindex.remove_repeats(table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = warc.write_archive(table(spark, sf_dir, "pages"))
    return warc.read_archive(spark, archive).select(
        warc.page_id_of(F.col("record_key")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        warc.page_id_of(F.col("refers_key")).alias("refers_to"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(table(spark, sf_dir, "documents")).drop("scored_spans")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents")).drop("words", "k")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_url_filters, op2_quality_rules, op3_source_mixing, op4_ngram_jaccard, op5_bpe, op6_suffix_array, op7_fm_index,
    op8_exact_dedup, op9_warc, op10_pii, op11_collocations, op12_filter_audit, op13_html_extraction)}

_URL = """
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), parts AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw_host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), lowered AS (
  SELECT page_id, path, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host FROM parts
), rules(rule_host, rule_path, rule_verdict) AS (
  VALUES {rules}
), fits AS (
  SELECT page_id, rule_host || rule_path AS rule, rule_verdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) AS r
  FROM lowered JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT l.page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict
FROM lowered l LEFT JOIN fits f ON l.page_id = f.page_id AND r = 1
""".format(rules=", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES))

_SPACE = r"[\x20\x09-\x0D]"

_EXACT = f"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS points, regexp_replace(coalesce(text, ''), '{_SPACE}', '', 'g') AS bare
  FROM documents
), g AS (
  SELECT doc_id, bare, count(*) OVER (PARTITION BY bare) AS group_size,
         first_value(doc_id) OVER (PARTITION BY bare ORDER BY points DESC, doc_id NULLS LAST) AS keep_id
  FROM n
)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept,
       sha256(bare) AS text_sha256
FROM g
"""

_WARC = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
), q AS (
  SELECT page_id, strlen(html) AS payload_bytes, hex, min(page_id) OVER (PARTITION BY html) AS first_id FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST((('0x' || substr(hex, CAST((i // 8) * 10 + 1 AS INT), 10))::BIGINT >> CAST(35 - 5 * (i % 8) AS INT)) & 31 AS INT) + 1,
    1)), '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM q
"""

_BUCKET = "((v >> greatest(length(bin(v)) - 7, 0)) << greatest(length(bin(v)) - 7, 0))"

_QUALITY = f"""
WITH t AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT rid, doc_id, lang, source, text,
         list_filter(regexp_split_to_array(text, '{_SPACE}+'), lambda x: x <> '') AS words FROM t
), grams AS (
  SELECT rid, i AS pos, list_slice(words, i, i + 7) AS gram
  FROM (SELECT rid, words, unnest(range(1, CAST(len(words) - 6 AS BIGINT))) AS i FROM w WHERE len(words) >= 8)
), doubled AS (
  SELECT rid, pos FROM (SELECT rid, pos, count(*) OVER (PARTITION BY rid, gram) AS n FROM grams) WHERE n > 1
), covered AS (
  SELECT rid, sum(least(8, coalesce(later - pos, 8))) AS n_repeat
  FROM (SELECT rid, pos, lead(pos) OVER (PARTITION BY rid ORDER BY pos) AS later FROM doubled) GROUP BY rid
), counts AS (
  SELECT w.rid, doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))
      - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]'))))
      AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat, 0) AS BIGINT) AS n_repeat_words,
    CAST(len(list_filter(range(1, CAST(len(words) AS BIGINT)), lambda i: words[i] = words[i + 1])) AS BIGINT) AS n_run_words
  FROM w LEFT JOIN covered c ON c.rid = w.rid
), based AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counts
), long_form AS (
  SELECT rid, lang, source, m, v FROM (
    SELECT rid, lang, source, unnest(['word_length', 'symbols', 'dup_lines', 'repeats', 'long_repeats', 'runs']) AS m,
      unnest([100 * word_chars // n_words, 1000 * n_symbols // n_words, 1000 * n_dup_lines // n_words,
              1000 * n_repeat_words // n_words, CASE WHEN n_repeat_words < 32 THEN 0 ELSE 1000 * n_repeat_words // n_words END,
              1000 * n_run_words // n_words]) AS v
    FROM based WHERE NOT base_failed)
), sketch AS (
  SELECT lang, source, m, {_BUCKET} AS b, count(*) AS n FROM long_form GROUP BY ALL
), share_all AS (
  SELECT m, b, sum(n) / sum(sum(n)) OVER (PARTITION BY m) AS share FROM sketch GROUP BY m, b
), d_lang AS (SELECT lang, m, sum(n) AS docs FROM sketch GROUP BY lang, m
), share_lang AS (
  SELECT x.lang, x.m, b, sum(x.n) / (any_value(docs) + 100) AS share
  FROM (SELECT lang, m, b, n::DOUBLE AS n FROM sketch
        UNION ALL SELECT lang, d.m, b, 100 * share FROM d_lang d JOIN share_all a ON a.m = d.m) x
  JOIN d_lang d ON x.lang IS NOT DISTINCT FROM d.lang AND x.m = d.m GROUP BY x.lang, x.m, b
), d_own AS (SELECT lang, source, m, sum(n) AS docs FROM sketch GROUP BY lang, source, m
), mixed AS (
  SELECT x.lang, x.source, x.m, b, sum(x.n) AS n, any_value(docs) + 100 AS total
  FROM (SELECT lang, source, m, b, n::DOUBLE AS n FROM sketch
        UNION ALL SELECT d.lang, source, d.m, b, 100 * share FROM d_own d JOIN share_lang l
          ON d.lang IS NOT DISTINCT FROM l.lang AND d.m = l.m) x
  JOIN d_own d ON x.lang IS NOT DISTINCT FROM d.lang AND x.source IS NOT DISTINCT FROM d.source AND x.m = d.m
  GROUP BY x.lang, x.source, x.m, b
), limits AS (
  SELECT lang, source, m, min(b) FILTER (4 * upto >= total) AS q1, min(b) FILTER (4 * upto >= 3 * total) AS q3
  FROM (SELECT *, sum(n) OVER (PARTITION BY lang, source, m ORDER BY b) AS upto FROM mixed) GROUP BY lang, source, m
), bad AS (
  SELECT DISTINCT x.rid FROM long_form x JOIN limits l
    ON x.lang IS NOT DISTINCT FROM l.lang AND x.source IS NOT DISTINCT FROM l.source AND x.m = l.m
  WHERE v > q3 + 6 * (q3 - q1) + CASE x.m WHEN 'dup_lines' THEN 50 WHEN 'repeats' THEN 290 WHEN 'long_repeats' THEN 150 ELSE 100 END
     OR x.m = 'word_length' AND v < q1 - 6 * (q3 - q1) - 100
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND bad.rid IS NULL AS kept, n_run_words
FROM based LEFT JOIN bad ON bad.rid = based.rid
"""

_COLLOCATIONS = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')),
    '[^\x20\x09]+') AS w
  FROM documents
), one AS (
  SELECT lang, w[i] AS phrase, count(*) AS f FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces) GROUP BY ALL
), two AS (
  SELECT lang, w[i] AS w1, w[i + 1] AS w2, count(*) AS f
  FROM (SELECT lang, w, unnest(range(1, len(w))) AS i FROM pieces) GROUP BY ALL HAVING count(*) >= 10
), three AS (
  SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3, count(*) AS f
  FROM (SELECT lang, w, unnest(range(1, len(w) - 1)) AS i FROM pieces) GROUP BY ALL HAVING count(*) >= 10
), cuts AS (
  SELECT two.lang, w1 || ' ' || w2 AS phrase, 1 AS k, two.f AS a, x.f AS l, y.f AS r
  FROM two JOIN one x ON x.lang = two.lang AND x.phrase = w1 JOIN one y ON y.lang = two.lang AND y.phrase = w2
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, 1, t.f, x.f, y.f
  FROM three t JOIN one x ON x.lang = t.lang AND x.phrase = t.w1
    JOIN two y ON y.lang = t.lang AND y.w1 = t.w2 AND y.w2 = t.w3
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, 2, t.f, x.f, y.f
  FROM three t JOIN two x ON x.lang = t.lang AND x.w1 = t.w1 AND x.w2 = t.w2
    JOIN one y ON y.lang = t.lang AND y.phrase = t.w3
), scored AS (
  SELECT *, (1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS score FROM cuts
), weakest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), longer AS (
  SELECT lang, phrase, max(f) AS f FROM (
    SELECT lang, w1 || ' ' || w2 AS phrase, f FROM three UNION ALL SELECT lang, w2 || ' ' || w3, f FROM three) GROUP BY ALL
), free AS (
  SELECT weakest.* FROM weakest LEFT JOIN longer USING (lang, phrase) WHERE f IS NULL OR 100 * f < 50 * a
), totals AS (
  SELECT lang, sum(f) AS n FROM one GROUP BY lang
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM free JOIN totals USING (lang)
QUALIFY rank <= 2000
"""

_AUDIT = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    CASE WHEN len(w) < 50 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 5 * length(text) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN d.doc_id > min(d.doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END AS fails
  FROM d LEFT JOIN l ON d.doc_id = l.doc_id
), c AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL
), letters(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
  SELECT filter_order, step, substr(filter_order, 1, step - 1) AS before, substr(filter_order, step, 1) AS own
  FROM orders, (SELECT unnest(range(1, 6)) AS step)
), judged AS (
  SELECT part, filter_order, step, own, n, good, toxic, contains(fails, own) AS hit,
         length(translate(fails, before, '')) < length(fails) AS earlier, fails = own AS alone
  FROM c, steps
), counted AS (
  SELECT part, filter_order, step, own,
    sum(CASE WHEN NOT hit AND NOT earlier THEN n ELSE 0 END) AS kept, sum(CASE WHEN hit AND NOT earlier THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN hit AND earlier THEN n ELSE 0 END) AS redundant, sum(CASE WHEN alone THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN hit AND NOT earlier THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN hit AND NOT earlier THEN toxic ELSE 0 END) AS toxic_lost
  FROM judged GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM counted
"""

ORACLES: dict[str, str] = {
    "op1_url_filters": _URL, "op2_quality_rules": _QUALITY, "op8_exact_dedup": _EXACT, "op9_warc": _WARC,
    "op11_collocations": _COLLOCATIONS, "op12_filter_audit": _AUDIT}
