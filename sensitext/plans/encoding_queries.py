"""Queries over tokenising, vocabulary, WordPiece and model inputs."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from sensitext.constants import MAX_LENGTH, TRAIN_BATCH, UNK_ID, VOCAB_SIZE
from sensitext.functions.text import (
    add_specials_and_truncate,
    attention_mask,
    basic_tokens,
    leading_tokens,
    token_type_ids,
)
from sensitext.operators.encoding import (
    as_int32,
    build_vocab,
    add_model_inputs,
    length_profile,
    pad,
    tokens_to_ids,
    word_counts,
    wordpiece,
)
from sensitext.operators.grams import frequent_grams
from sensitext.operators.prep import assign_batches
from sensitext.plans.inputs import SQL_LABELLED, documents, labelled_ids, r6, sql_r6
from sensitext.plans.text_sql import sql_encoded, sql_tokens, sql_vocab, sql_wordpiece
from sensitext.session import materialise

# A small vocabulary makes most words fall into pieces.
SMALL_VOCAB = 2000
# Rows that a frequent gram stands in.
GRAM_ROWS = 5


def _joined(ids: Column | str) -> Column:
    return F.array_join(ids, " ")


def _encoded(spark, data_dir):
    vocab = build_vocab(documents(spark, data_dir), VOCAB_SIZE)
    return labelled_ids(spark, data_dir, vocab).withColumnRenamed("label", "labels")


def basic_tokens_query(spark, data_dir):
    tokens = documents(spark, data_dir).select("doc_id", basic_tokens("text").alias("tokens"))
    return tokens.select(
        "doc_id", F.size("tokens").alias("n"), _joined("tokens").alias("tokens")
    )


def frequent_grams_query(spark, data_dir):
    """Words and pairs of neighbours that stand in ``GRAM_ROWS`` documents at least."""
    tokens = documents(spark, data_dir).select(basic_tokens("text").alias("tokens"))
    return frequent_grams(tokens, "tokens", 2, GRAM_ROWS)


def build_vocab_query(spark, data_dir):
    return build_vocab(documents(spark, data_dir), VOCAB_SIZE)


def wordpiece_query(spark, data_dir):
    docs = documents(spark, data_dir)
    words = word_counts(docs).select("word")
    pieces = wordpiece(words, build_vocab(docs, SMALL_VOCAB))
    return pieces.select("word", _joined("pieces").alias("pieces"))


def token_ids(spark, data_dir):
    docs = documents(spark, data_dir)
    tokens = docs.select("doc_id", basic_tokens("text").alias("tokens"))
    ids = tokens_to_ids(tokens, build_vocab(docs, SMALL_VOCAB))
    return ids.select("doc_id", _joined("ids").alias("ids"))


def truncate_specials(spark, data_dir):
    docs = documents(spark, data_dir)
    # Each token gives one id, so tokens beyond the room of the ids cannot matter.
    tokens = docs.select("doc_id", leading_tokens("text", MAX_LENGTH - 2).alias("tokens"))
    ids = tokens_to_ids(tokens, build_vocab(docs, SMALL_VOCAB))
    return ids.select("doc_id", _joined(add_specials_and_truncate("ids")).alias("ids"))


def pad_longest(spark, data_dir):
    rows = _encoded(spark, data_dir).select("doc_id", "split", "input_ids")
    # Read for the numbers and for their offsets, so the texts are encoded once.
    rows = materialise(rows, "encoded")
    batched = assign_batches(rows, TRAIN_BATCH, "doc_id", epochs=[1, 2], by=["split"])
    padded = pad(batched, "longest", batch_col=("split", "epoch", "batch_id"))
    return padded.select(
        "doc_id",
        "split",
        "epoch",
        "batch_id",
        F.size("input_ids").alias("n"),
        _joined("input_ids").alias("input_ids"),
    )


def length_batches(spark, data_dir):
    """Padding of batches with rows in random order beside batches of like lengths."""
    rows = _encoded(spark, data_dir).select("doc_id", "split", F.size("input_ids").alias("n"))
    # Both orders read the rows twice, so the texts are encoded once.
    rows = materialise(rows, "lengths")
    totals = []
    for order, length in (("random", None), ("length", "n")):
        batched = assign_batches(rows, TRAIN_BATCH, "doc_id", by=["split"], length=length)
        sizes = batched.groupBy("split", "batch_id").agg(
            (F.max("n") * F.count(F.lit(1)) - F.sum("n")).alias("padding")
        )
        totals.append(
            sizes.groupBy("split", F.lit(order).alias("order")).agg(
                F.count(F.lit(1)).alias("n_batches"), F.sum("padding").alias("padding_longest")
            )
        )
    return totals[0].unionByName(totals[1])


def pad_max(spark, data_dir):
    padded = pad(_encoded(spark, data_dir), "max_length")
    return padded.select("doc_id", _joined("input_ids").alias("input_ids"))


def attention_mask_query(spark, data_dir):
    mask = attention_mask(F.size("input_ids"), MAX_LENGTH)
    return _encoded(spark, data_dir).select("doc_id", _joined(mask).alias("attention_mask"))


def token_type_ids_query(spark, data_dir):
    rows = pad(_encoded(spark, data_dir), "max_length")
    return rows.select("doc_id", _joined(token_type_ids("input_ids")).alias("token_type_ids"))


def int32_inputs(spark, data_dir):
    rows = add_model_inputs(_encoded(spark, data_dir), "max_length")
    wide = rows.withColumn("input_ids", F.col("input_ids").cast("array<bigint>"))
    return as_int32(wide).select(
        "doc_id",
        F.expr("typeof(input_ids)").alias("kind"),
        _joined("input_ids").alias("input_ids"),
        _joined("attention_mask").alias("attention_mask"),
    )


def encode_query(spark, data_dir):
    return add_model_inputs(_encoded(spark, data_dir)).select(
        "doc_id",
        *[_joined(c).alias(c) for c in ("input_ids", "attention_mask", "token_type_ids")],
        "labels",
        "truncated",
    )


def length_profile_query(spark, data_dir):
    rows = _encoded(spark, data_dir).select("doc_id", "split", "input_ids", "truncated")
    batched = assign_batches(rows, TRAIN_BATCH, "doc_id", by=["split"])
    profile = length_profile(batched, batch_col=("split", "batch_id"))
    real = ("mean_length", "median_length", "p95_length", "truncated_share")
    return profile.withColumns({c: r6(c) for c in real})


QUERIES = {
    "basic_tokens": basic_tokens_query,
    "frequent_grams": frequent_grams_query,
    "build_vocab": build_vocab_query,
    "wordpiece": wordpiece_query,
    "token_ids": token_ids,
    "truncate_specials": truncate_specials,
    "pad_longest": pad_longest,
    "length_batches": length_batches,
    "pad_max": pad_max,
    "attention_mask": attention_mask_query,
    "token_type_ids": token_type_ids_query,
    "int32_inputs": int32_inputs,
    "encode": encode_query,
    "length_profile": length_profile_query,
}


def _text(ids: str) -> str:
    return f"array_to_string({ids}, ' ')"


def _repeat(value: int, n: str) -> str:
    return f"list_transform(range({n}), lambda x: {value})"


def _padded(length: str) -> str:
    return f"list_concat(ids, {_repeat(0, f'{length} - len(ids)')})"


_MASK = f"list_concat({_repeat(1, 'len(ids)')}, {_repeat(0, f'{MAX_LENGTH} - len(ids)')})"
_WITH_ENCODED = (
    f"WITH RECURSIVE {SQL_LABELLED}, {sql_vocab('documents', VOCAB_SIZE)}, "
    f"{sql_encoded('labelled', 'label, split')}"
)
_WITH_IDS = f"""WITH {sql_vocab('documents', SMALL_VOCAB)},
    rows AS (SELECT doc_id, unnest(toks) AS word, generate_subscripts(toks, 1) AS pos
      FROM (SELECT doc_id, {sql_tokens('text')} AS toks FROM documents)),
    found AS (SELECT doc_id, list(coalesce(id, {UNK_ID}) ORDER BY pos) AS ids
      FROM rows LEFT JOIN vocab ON token = word GROUP BY doc_id),
    ids AS (SELECT doc_id, coalesce(ids, []) AS ids
      FROM documents LEFT JOIN found USING (doc_id))"""
_BATCHES = f"""batched AS (
    SELECT *, (row_number() OVER (PARTITION BY split, epoch
        ORDER BY md5(doc_id || ':42:' || epoch), doc_id) - 1) // {TRAIN_BATCH} AS batch_id
      FROM (SELECT encoded.*, e::INT AS epoch FROM encoded, range(1, 3) r(e)))"""

ORACLE = {
    "basic_tokens": f"""SELECT doc_id, len(toks)::INT AS n, {_text('toks')} AS tokens
        FROM (SELECT doc_id, {sql_tokens('text')} AS toks FROM documents)""",
    "frequent_grams": f"""WITH toks AS MATERIALIZED (
          SELECT doc_id, {sql_tokens('text')} AS t FROM documents WHERE text IS NOT NULL),
        cells AS (SELECT DISTINCT doc_id, unnest(t) AS gram, 1 AS size FROM toks
          UNION ALL SELECT DISTINCT doc_id,
            unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])), 2 FROM toks)
        SELECT gram, size, count(*) AS n_rows FROM cells GROUP BY gram, size
        HAVING count(*) >= {GRAM_ROWS}""",
    "build_vocab": f"WITH {sql_vocab('documents', VOCAB_SIZE)} SELECT token, id FROM vocab",
    "wordpiece": f"""WITH RECURSIVE {sql_vocab('documents', SMALL_VOCAB)},
        todo AS MATERIALIZED (SELECT DISTINCT unnest({sql_tokens('text')}) AS word
          FROM documents),
        {sql_wordpiece()} SELECT word, {_text('pieces')} AS pieces FROM word_pieces""",
    "token_ids": f"{_WITH_IDS} SELECT doc_id, {_text('ids')} AS ids FROM ids",
    "truncate_specials": f"""{_WITH_IDS} SELECT doc_id,
        {_text(f"list_concat(list_concat([101], ids[1:{MAX_LENGTH - 2}]), [102])")} AS ids
        FROM ids""",
    "pad_longest": f"""{_WITH_ENCODED}, {_BATCHES},
        sized AS (SELECT *, max(len(ids)) OVER (PARTITION BY split, epoch, batch_id) AS longest
          FROM batched)
        SELECT doc_id, split, epoch, batch_id, longest::INT AS n, {_text(_padded('longest'))} AS input_ids
        FROM sized""",
    "length_batches": f"""{_WITH_ENCODED},
        orders AS (SELECT split, len(ids) AS n, 'random' AS "order",
            row_number() OVER (PARTITION BY split ORDER BY md5(doc_id || ':42:1'), doc_id) AS r
          FROM encoded
          UNION ALL SELECT split, len(ids), 'length',
            row_number() OVER (PARTITION BY split ORDER BY len(ids), md5(doc_id || ':42:1'), doc_id)
          FROM encoded),
        sizes AS (SELECT split, "order", max(n) * count(*) - sum(n) AS padding
          FROM orders GROUP BY split, "order", (r - 1) // {TRAIN_BATCH})
        SELECT split, "order", count(*) AS n_batches, sum(padding)::BIGINT AS padding_longest
        FROM sizes GROUP BY "order", split""",
    "pad_max": f"""{_WITH_ENCODED}
        SELECT doc_id, {_text(_padded(str(MAX_LENGTH)))} AS input_ids FROM encoded""",
    "attention_mask": f"""{_WITH_ENCODED}
        SELECT doc_id, {_text(_MASK)} AS attention_mask FROM encoded""",
    "token_type_ids": f"""{_WITH_ENCODED}
        SELECT doc_id, {_text(_repeat(0, str(MAX_LENGTH)))} AS token_type_ids FROM encoded""",
    "int32_inputs": f"""{_WITH_ENCODED}
        SELECT doc_id, 'array<int>' AS kind, {_text(_padded(str(MAX_LENGTH)))} AS input_ids,
          {_text(_MASK)} AS attention_mask FROM encoded""",
    "encode": f"""{_WITH_ENCODED} SELECT doc_id, {_text('ids')} AS input_ids,
          {_text(_repeat(1, 'len(ids)'))} AS attention_mask,
          {_text(_repeat(0, 'len(ids)'))} AS token_type_ids, label AS labels, truncated
        FROM encoded""",
    "length_profile": f"""{_WITH_ENCODED}, {_BATCHES},
        waste AS (SELECT split, sum(w)::BIGINT AS padding_longest FROM (
          SELECT split, max(len(ids)) * count(*) - sum(len(ids)) AS w
          FROM batched WHERE epoch = 1 GROUP BY split, batch_id) GROUP BY split)
        SELECT split, count(*) AS n_rows, {sql_r6('avg(len(ids))')} AS mean_length,
          max(len(ids))::INT AS max_length,
          {sql_r6('quantile_cont(len(ids), 0.5)')} AS median_length,
          {sql_r6('quantile_cont(len(ids), 0.95)')} AS p95_length,
          {sql_r6('avg(truncated::INT)')} AS truncated_share,
          sum({MAX_LENGTH} - len(ids))::BIGINT AS padding_fixed,
          any_value(padding_longest) AS padding_longest
        FROM encoded JOIN waste USING (split) GROUP BY split""",
}
