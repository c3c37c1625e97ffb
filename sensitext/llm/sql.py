"""SQL twins of the queries that SQL can express."""

from __future__ import annotations

from sensitext.llm.licences import (
    COPYRIGHT_LINE,
    DIGESTS,
    LICENCES,
    LINE_BREAKS,
    LOWER,
    NOTICES,
    PHRASES,
    PUNCTUATION,
    SPELLINGS,
    UPPER,
    titled,
)
from sensitext.llm.quality_rules import MARKS, RULES, STOP_WORDS
from sensitext.llm.sharding import BITS, LIMIT_BYTES, ROW_BYTES
from sensitext.llm.spelling import MIN_CHARS, MIN_COUNT, RATIO, TYPO
from sensitext.llm.vector_codes import ENTRIES, PARTS, ROUNDS, SCALE


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def listed(values) -> str:
    return "[" + ", ".join(map(quoted, values)) + "]"


_SPACES = r"[\x20\x09-\x0D]"
_RATIOS = {
    "mean_word_chars": "word_chars::DOUBLE / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols::DOUBLE / greatest(n_words, 1)",
    "exclamations_per_word": "n_exclamations::DOUBLE / greatest(n_words, 1)",
    "stop_word_ratio": "n_stop::DOUBLE / greatest(n_words, 1)",
    "dup_line_ratio": "n_dup_lines::DOUBLE / greatest(len(ls), 1)",
    "bullet_line_ratio": "n_bullets::DOUBLE / greatest(len(ls), 1)",
    "ellipsis_line_ratio": "n_ellipses::DOUBLE / greatest(len(ls), 1)",
}


def _failed(rule) -> str:
    value = _RATIOS[rule.measure]
    tests = [f"{value} < {rule.least}"] * (rule.least is not None)
    tests += [f"{value} > {rule.most}"] * (rule.most is not None)
    return f"CASE WHEN n_words >= {rule.from_words} AND ({' OR '.join(tests)}) THEN '{rule.name}' END"


QUALITY_RULES = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
split AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_replace(x, '{_SPACES}', '', 'g') != '') AS ls
  FROM t),
wins AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n
  FROM (SELECT doc_id, i, list_slice(w, i, i + 4) AS g
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM split))),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM wins, range(5) r(k) WHERE n > 1 GROUP BY doc_id),
counts AS (
  SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '{_SPACES}', '', 'g')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         length(t) - length(replace(t, '!', '')) AS n_exclamations,
         len(ls) - len(list_distinct(ls)) AS n_dup_lines, ls,
         len(list_filter(ls, lambda x: regexp_matches(x, '^ *[-*•]'))) AS n_bullets,
         len(list_filter(ls, lambda x: regexp_matches(x, '(\\.\\.\\.|…) *$'))) AS n_ellipses,
         len(list_filter(w, lambda x: list_contains({listed(STOP_WORDS)}, lower(trim(x, {quoted(MARKS)}))))) AS n_stop,
         coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM split LEFT JOIN covered USING (doc_id)),
judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         list_filter([{", ".join(map(_failed, RULES))}], lambda x: x IS NOT NULL) AS failed
  FROM counts)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
       n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND len(failed) = 0 AS kept, array_to_string(failed, ',') AS failed_rules
FROM judged"""

SHARDING = f"""
WITH rows AS (
  SELECT doc_id, strlen(coalesce(text, '')) + {ROW_BYTES} AS bytes,
         lpad(bin(('0x' || substr(md5(doc_id::VARCHAR), 1, {BITS // 4}))::BIGINT), {BITS}, '0') AS bits
  FROM documents),
prefixes AS (SELECT *, substr(bits, 1, d) AS prefix FROM rows, range({BITS + 1}) r(d)),
fit AS (SELECT prefix FROM prefixes GROUP BY prefix HAVING sum(bytes) <= {LIMIT_BYTES})
SELECT doc_id, bytes::BIGINT AS bytes, 'b' || min_by(prefix, d) AS shard, 0::INT AS page
FROM prefixes JOIN fit USING (prefix) GROUP BY doc_id, bytes"""


def _canonical(text: str) -> str:
    x = f"translate({text}, '{UPPER}' || chr(13), '{LOWER}' || chr(10))"
    x = f"regexp_replace({x}, '{COPYRIGHT_LINE}', '\\1', 'g')"
    x = f"regexp_replace({x}, '{PUNCTUATION}', ' ', 'g')"
    for old, new in SPELLINGS:
        x = f"replace({x}, '{old}', '{new}')"
    return f"trim(regexp_replace({x}, '{LINE_BREAKS}', chr(10), 'g'), ' ' || chr(10))"


def _whole_digest(form: str) -> str:
    x = f"replace({form}, chr(10), ' ')"
    for old, new in PHRASES:
        x = f"replace({x}, '{old}', '{new}')"
    return f"md5({x})"


def _table(rows) -> str:
    return ", ".join(f"({quoted(a)}, {quoted(b)})" for a, b in rows)


LICENCE_SCAN = f"""
WITH whole AS (
  SELECT digest, min(l) AS license FROM (
    SELECT {_whole_digest(_canonical("t"))} AS digest, l
    FROM (VALUES {_table(titled(LICENCES))}) v(l, t)
    UNION ALL SELECT * FROM (VALUES {_table(DIGESTS.items())}) d(digest, l)) GROUP BY digest),
notice AS (
  SELECT {_whole_digest(_canonical("t"))} AS digest, min(l) AS license
  FROM (VALUES {_table((n, x) for x, n in NOTICES.items())}) v(l, t) GROUP BY 1),
form AS (SELECT doc_id, {_canonical("coalesce(text, '')")} AS f FROM documents),
lines AS (SELECT doc_id, unnest(string_split(f, chr(10))) AS line FROM form),
hits AS (
  SELECT doc_id, count(*) AS n_notices, string_agg(DISTINCT license, ',' ORDER BY license) AS notices
  FROM lines JOIN notice ON md5(line) = digest GROUP BY doc_id)
SELECT doc_id, {_whole_digest("f")} AS digest, license,
       coalesce(n_notices, 0)::BIGINT AS n_notices, coalesce(notices, '') AS notices
FROM form LEFT JOIN hits USING (doc_id)
LEFT JOIN whole ON {_whole_digest("f")} = digest"""


# Code points of the accented letters, and ASCII characters that stand for them one by one, since
# DuckDB's edit distance counts bytes.
_ACCENTED = "".join(map(chr, range(0xC0, 0x100)))
_STAND_IN = "".join(c for c in map(chr, range(33, 127)) if not c.islower() and c != "'")[:64]
_CRC_TABLE = (
    "list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), "
    "lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END))"
)

SPELLING_VARIANTS = f"""
WITH RECURSIVE crc AS MATERIALIZED (SELECT {_CRC_TABLE} AS t),
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS d, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[a-z\u00C0-\u00FF]{{{MIN_CHARS},}}')) AS w
  FROM documents),
counted AS (SELECT d, w, count(*) AS n FROM runs GROUP BY d, w),
hashed AS (
  SELECT w, n, xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(
           string_split(d || ':' || w, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT]
             ELSE [192 + unicode(c) // 64, 128 + unicode(c) % 64] END))),
         lambda a, b: xor(a // 256, t[xor(a % 256, b) + 1]))) AS h
  FROM counted, crc),
spelled AS (
  SELECT CASE WHEN h % {TYPO} = 0
           THEN substr(w, 1, (h % length(w))::BIGINT) || substr(w, (h % length(w))::BIGINT + 2)
           ELSE w END AS word, n
  FROM hashed),
words AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n, translate(word, '{_ACCENTED}', '{_STAND_IN}') AS x
  FROM spelled GROUP BY word HAVING length(word) >= {MIN_CHARS} AND sum(n) >= {MIN_COUNT}),
near AS MATERIALIZED (
  SELECT a.word, count(*) AS n_near, min(struct_pack(less := -b.n, form := b.word)) AS top
  FROM words a JOIN words b ON abs(length(a.x) - length(b.x)) <= 1 AND a.x <> b.x
    AND levenshtein(a.x, b.x) = 1
  GROUP BY a.word),
formed AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
         CASE WHEN -top.less >= {RATIO} * w.n THEN top.form END AS form,
         CASE WHEN -top.less >= {RATIO} * w.n THEN -top.less END::BIGINT AS form_n
  FROM words w LEFT JOIN near USING (word)),
chain AS (
  SELECT word, word AS at FROM formed
  UNION ALL SELECT c.word, f.form FROM chain c JOIN formed f ON c.at = f.word WHERE f.form IS NOT NULL),
ends AS (SELECT c.word, c.at AS root FROM chain c JOIN formed f ON c.at = f.word WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)"""


def _vector_codes() -> str:
    """Lloyd's rounds with all distances, one chain of tables a round."""
    sql = f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
part AS MATERIALIZED (
  SELECT vec_id, p, v[p * len(v) // {PARTS} + 1 : (p + 1) * len(v) // {PARTS}] AS x
  FROM kept, range({PARTS}) r(p)),
first AS (
  SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT {ENTRIES}),
book0 AS MATERIALIZED (SELECT p, e, x AS c FROM part JOIN first USING (vec_id))"""
    for k in range(ROUNDS + 1):
        sql += f""",
near{k} AS MATERIALIZED (
  SELECT vec_id, p, any_value(x) AS x, min(struct_pack(
           d := list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT,
           e := e)) AS best
  FROM part JOIN book{k} USING (p) GROUP BY vec_id, p)"""
        if k < ROUNDS:
            sql += f""",
mean{k} AS (
  SELECT p, e, list(floor(s / n)::BIGINT ORDER BY i) AS c FROM (
    SELECT p, best.e AS e, i, sum(x[i]) AS s, count(*)::DOUBLE AS n
    FROM near{k}, unnest(range(1, len(x) + 1)) u(i) GROUP BY p, best.e, i) GROUP BY p, e),
book{k + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(m.c, b.c) AS c FROM book{k} b LEFT JOIN mean{k} m USING (p, e))"""
    return f"""{sql},
coded AS (
  SELECT vec_id, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code,
         sum(best.d)::BIGINT AS error
  FROM near{ROUNDS} GROUP BY vec_id)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM book{ROUNDS})
         AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)"""


# For pages whose main text is one article element of headings and paragraphs, with the character
# references that stand in the given tables: SQL has neither a reader of HTML nor a table of references.
MAIN_TEXT = r"""
WITH article AS (
  SELECT page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*?)</article>', 1, 's') AS body
  FROM pages),
blocks AS (
  SELECT page_id, url, list_transform(regexp_split_to_array(body, '</?(?:h1|p)>'), lambda x:
    trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(x, '<[^>]*>', '', 'g'),
      '&quot;?', '"', 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) AS parts
  FROM article),
joined AS (
  SELECT page_id, url, array_to_string(list_filter(parts, lambda x: x <> ''), chr(10)) AS text FROM blocks)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM joined"""

ORACLE = {
    "op1_quality_rules": QUALITY_RULES,
    "op8_licences": LICENCE_SCAN,
    "op10_sharding": SHARDING,
    "op11_spelling_variants": SPELLING_VARIANTS,
    "op12_vector_codes": _vector_codes(),
    "op13_main_text": MAIN_TEXT,
}
