"""Kinds of text over the given tables, with the model of letter pairs learnt from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensitext.operators.text_kinds import MIN_PAIRS, SYMBOLS, fit_pairs, text_kind
from sensitext.plans.inputs import table


def text_kinds(spark, data_dir):
    """Documents, turns and words by kind, counted by where they come from.

    Words of texts stand in for short probes: every distinct word of a document is judged too.
    """
    docs = table(spark, data_dir, "documents", F.lit("documents").alias("origin"), "text")
    turns = table(spark, data_dir, "conversations", F.lit("conversations").alias("origin"), "text")
    words = docs.select(
        F.lit("words").alias("origin"),
        F.explode(F.array_distinct(F.split("text", r"[ \t\n\r]+"))).alias("text"),
    )
    model = fit_pairs(docs)
    once = F.lit(1).cast("bigint").alias("n")
    # Texts are judged as they come; of a word only its documents are counted before it is judged.
    counted = words.groupBy("origin", "text").agg(F.count(F.lit(1)).alias("n"))
    texts = docs.select("*", once).unionByName(turns.select("*", once)).unionByName(counted)
    return texts.groupBy("origin", text_kind(F.col("text"), model).alias("kind")).agg(
        F.sum("n").alias("n")
    )


QUERIES = {"text_kinds": text_kinds}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_FORM = f"trim(regexp_replace({_LOWER}, '[^a-z]+', ' ', 'g'), ' ')"
_CODES = (
    f"list_transform(string_split({_FORM}, ''), "
    f"lambda c: CASE WHEN c = ' ' THEN {SYMBOLS - 1} ELSE unicode(c) - 97 END)"
)
_PAIRS = f"list_transform(range(1, len(codes)), lambda i: codes[i] * {SYMBOLS} + codes[i + 1])"

ORACLE = {
    "text_kinds": rf"""
WITH texts AS (
  SELECT 'documents' AS origin, text FROM documents
  UNION ALL SELECT 'conversations', text FROM conversations
  UNION ALL SELECT 'words', unnest(list_distinct(regexp_split_to_array(text, '[ \t\n\r]+')))
    FROM documents),
coded AS (
  SELECT origin, regexp_replace(coalesce(text, ''), '[ \t\n\r]+', '', 'g') AS solid, {_CODES} AS codes
  FROM texts),
paired AS (
  SELECT origin, solid, CASE WHEN len(codes) > 1 THEN {_PAIRS} ELSE [] END AS pairs FROM coded),
counts AS (
  SELECT pair, count(*) AS n
  FROM (SELECT unnest(pairs) AS pair FROM paired WHERE origin = 'documents') GROUP BY pair),
filled AS (
  SELECT k, coalesce(n, 0) AS n, sum(coalesce(n, 0)) OVER (PARTITION BY k // {SYMBOLS}) AS firsts
  FROM range({SYMBOLS * SYMBOLS}) r(k) LEFT JOIN counts ON pair = k),
logs AS (SELECT k, n, ln((n + 1)::DOUBLE / (firsts + {SYMBOLS})) AS lp FROM filled),
model AS (
  SELECT list(lp ORDER BY k) AS log_p, (sum(n * lp) / sum(n) + avg(lp)) / 2 AS least FROM logs),
judged AS (
  SELECT origin, CASE
      WHEN solid = '' THEN 'blank'
      WHEN regexp_full_match(solid, '[0-9]+') THEN 'digits'
      WHEN length(solid) > 1 AND replace(solid, substr(solid, 1, 1), '') = '' THEN 'repeated'
      WHEN regexp_full_match(solid, '[A-Za-z]+') AND len(pairs) >= {MIN_PAIRS}
        AND list_sum(list_transform(pairs, lambda k: log_p[k + 1])) / len(pairs) < least THEN 'noise'
      ELSE 'text' END AS kind
  FROM paired, model)
SELECT origin, kind, count(*) AS n FROM judged GROUP BY origin, kind"""
}
