"""SQL twins of tokenising, vocabulary, WordPiece and encoding."""

from __future__ import annotations

from sensitext.constants import (
    FIRST_FREE_ID,
    MAX_LENGTH,
    MAX_WORD_CHARS,
    SPECIAL_TOKENS,
    UNK_ID,
    VOCAB_SIZE,
)
from sensitext.functions.text import CJK

_CLEAN = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x{9f}\x{FFFD}\p{Cf}\p{Co}]"
_SPECIAL = r"\[(?:" + "|".join(t.strip("[]") for t in SPECIAL_TOKENS) + r")\]"
_TOKEN = (
    _SPECIAL
    + rf"|[{CJK}]|[[:punct:]\pP]|[^\s\p{{Z}}[:punct:]\pP{CJK}]+"
)
_SPECIAL_ROWS = ", ".join(f"('{t}', {i}::INT)" for t, i in SPECIAL_TOKENS.items())
_SPECIAL_LIST = ", ".join(f"'{t}'" for t in SPECIAL_TOKENS)


def sql_tokens(text: str) -> str:
    return f"regexp_extract_all(regexp_replace({text}, '{_CLEAN}', '', 'g'), '{_TOKEN}')"


def sql_vocab(source: str = "documents", size: int = VOCAB_SIZE) -> str:
    """CTEs up to ``vocab(token, id)``, built from whole texts."""
    chars = "regexp_extract_all(word, '(?s).')"
    return f"""corpus_words AS MATERIALIZED (
  SELECT word, count(*) AS n FROM (SELECT unnest({sql_tokens('text')}) AS word FROM {source})
  WHERE length(word) <= {MAX_WORD_CHARS} AND word NOT IN ({_SPECIAL_LIST}) GROUP BY word),
corpus_chars AS (
  SELECT c, sum(n) AS n FROM (SELECT unnest({chars}) AS c, n FROM corpus_words) GROUP BY c),
candidates AS (
  SELECT c AS token, n, 1 AS is_char FROM corpus_chars
  UNION ALL SELECT '##' || c, n, 1 FROM corpus_chars
  UNION ALL SELECT word, n, 0 FROM corpus_words WHERE length(word) > 1),
vocab AS MATERIALIZED (
  SELECT token, (r + {FIRST_FREE_ID - 1})::INT AS id FROM (
    SELECT token, row_number() OVER (ORDER BY is_char DESC, n DESC, token) AS r FROM candidates)
  WHERE r <= {size - FIRST_FREE_ID}
  UNION ALL SELECT * FROM (VALUES {_SPECIAL_ROWS}) s(token, id))"""


def sql_wordpiece() -> str:
    """CTEs from ``todo(word)`` and ``vocab`` to ``word_pieces(word, pieces)``."""
    return f"""grown(word, p, pieces) AS (
  SELECT word, 1::BIGINT, []::VARCHAR[] FROM todo WHERE length(word) <= {MAX_WORD_CHARS}
  UNION ALL
  SELECT g.word, g.p + best.n, list_append(g.pieces, best.piece)
  FROM grown g, LATERAL (
    SELECT v.token AS piece, r.n FROM range(1, length(g.word) - g.p + 2) r(n)
    JOIN vocab v ON v.token
      = (CASE WHEN g.p > 1 THEN '##' ELSE '' END) || substr(g.word, g.p, r.n)
    ORDER BY r.n DESC LIMIT 1) best
  WHERE g.p <= length(g.word)),
split_words AS (SELECT word, pieces FROM grown WHERE p = length(word) + 1),
word_pieces AS MATERIALIZED (
  SELECT t.word,
    CASE WHEN t.word IN ({_SPECIAL_LIST}) THEN [t.word]
         ELSE coalesce(s.pieces, ['[UNK]']) END AS pieces
  FROM todo t LEFT JOIN split_words s USING (word))"""


def sql_encoded(source: str, keep: str = "", max_length: int = MAX_LENGTH) -> str:
    """CTEs from ``source(doc_id, text, ...)`` and ``vocab`` to ``encoded``.

    ``encoded`` has ``doc_id``, the ``keep`` columns, ``ids`` and ``truncated``.
    """
    extra = f", {keep}" if keep else ""
    return f"""doc_words AS MATERIALIZED (
  SELECT doc_id, toks[1:{max_length - 1}] AS toks
  FROM (SELECT doc_id, {sql_tokens('text')} AS toks FROM {source})),
doc_word_rows AS (
  SELECT doc_id, unnest(toks) AS word, generate_subscripts(toks, 1) AS pos FROM doc_words),
todo AS MATERIALIZED (SELECT DISTINCT word FROM doc_word_rows),
{sql_wordpiece()},
piece_rows AS (
  SELECT word, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS k FROM word_pieces),
word_ids AS (
  SELECT word, list(coalesce(id, {UNK_ID}) ORDER BY k) AS ids
  FROM piece_rows LEFT JOIN vocab ON token = piece GROUP BY word),
doc_ids AS (
  SELECT doc_id, flatten(list(ids ORDER BY pos)) AS ids
  FROM doc_word_rows JOIN word_ids USING (word) GROUP BY doc_id),
encoded AS MATERIALIZED (
  SELECT doc_id{extra},
    list_concat(list_concat([101], coalesce(ids, [])[1:{max_length - 2}]), [102]) AS ids,
    coalesce(len(ids), 0) > {max_length - 2} AS truncated
  FROM {source} LEFT JOIN doc_ids USING (doc_id))"""
