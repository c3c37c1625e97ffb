"""Inputs of the registered queries, as Spark frames and as SQL for the value check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sensitext.constants import MAX_LENGTH
from sensitext.functions.losses import ce_loss, kd_loss, total_loss
from sensitext.functions.scoring import argmax, linear_logits
from sensitext.operators.encoding import Vocab, encode
from sensitext.operators.prefilter import may_match
from sensitext.operators.prep import coerce_label, hash_split
from sensitext.session import materialise
from sensitext.sources.tables import labelled_from_tables, read_table

SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}
WIDTH = 64
# Two fixed linear heads over the embedding vectors.
TEACHER_HEADS = [[((i * 7 + j * 13) % 17 - 8) / 8 for i in range(WIDTH)] for j in range(2)]
STUDENT_HEADS = [[((i * 5 + j * 11) % 13 - 6) / 6 for i in range(WIDTH)] for j in range(2)]
TRACE_EPOCHS = 6


def r6(x: Column | str) -> Column:
    return F.round(x, 6)


def table(
    spark: SparkSession, data_dir: str, name: str, *columns: str | Column, spread: bool = False
) -> DataFrame:
    """One of the given tables, with its fixed schema."""
    return read_table(spark, data_dir, name, *columns, schema=SCHEMAS[name], spread=spread)


def documents(spark: SparkSession, data_dir: str) -> DataFrame:
    return table(spark, data_dir, "documents", "doc_id", "text", spread=True)


def labelled(spark: SparkSession, data_dir: str) -> DataFrame:
    """The split is computed below the join, so a plan that needs no text moves none."""
    labels = table(spark, data_dir, "labels", "doc_id", "toxic")
    docs = hash_split(table(spark, data_dir, "documents", "doc_id", "text"))
    rows = labelled_from_tables(docs, labels)
    return rows.select("doc_id", "text", "label", "split")


def labelled_ids(
    spark: SparkSession,
    data_dir: str,
    vocab: Vocab,
    max_length: int = MAX_LENGTH,
    store: bool = False,
) -> DataFrame:
    """``doc_id, label, split, input_ids, truncated``: encoded below the join with the labels.

    A Bloom filter over the labels' ids keeps other documents from being encoded. At most
    ``max_length`` numbers a document are moved, never its text. With ``store`` the rows are written
    once, for those who read them again; labels are checked by each of these.
    """
    labels = table(spark, data_dir, "labels", "doc_id", "toxic")
    docs = may_match(table(spark, data_dir, "documents", "doc_id", "text"), labels, "doc_id")
    encoded = encode(hash_split(docs), vocab, max_length)
    narrow = encoded.select("doc_id", "split", "input_ids", "truncated")
    rows = labelled_from_tables(narrow, labels)
    return coerce_label(materialise(rows, "labelled-ids") if store else rows)


def vectors(spark: SparkSession, data_dir: str) -> DataFrame:
    """``vec_id, digit, label, split, embedding`` with a two-class label."""
    split = F.when(F.col("vec_id") % 5 == 0, "validation").otherwise("train")
    return table(spark, data_dir, "embeddings").select(
        "vec_id",
        F.col("label").alias("digit"),
        (F.col("label") % 2).cast("int").alias("label"),
        split.alias("split"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )


def scored(spark: SparkSession, data_dir: str) -> DataFrame:
    """Vectors with the logits of both heads."""
    return vectors(spark, data_dir).withColumns(
        {
            "t_logits": linear_logits("embedding", TEACHER_HEADS),
            "s_logits": linear_logits("embedding", STUDENT_HEADS),
        }
    )


def trace(spark: SparkSession, data_dir: str) -> DataFrame:
    """A student on its way to the teacher: its logits move one sixth closer per epoch."""
    epochs = F.explode(F.sequence(F.lit(1), F.lit(TRACE_EPOCHS))).alias("epoch")
    rows = scored(spark, data_dir).select(
        "vec_id", "digit", "label", "split", "t_logits", "s_logits", epochs
    )
    return rows.withColumn("logits", moved_logits())


def moved_logits() -> Column:
    return F.zip_with(
        "s_logits", "t_logits", lambda s, t: s + (t - s) * F.col("epoch") / F.lit(TRACE_EPOCHS)
    )


def trace_loss() -> Column:
    return total_loss(ce_loss("logits", "label"), kd_loss("logits", "t_logits"))


def history(spark: SparkSession, data_dir: str) -> DataFrame:
    """Training history of one run per digit, computed from the trace.

    The evaluation loss is kept to one digit, so that ties occur.
    """
    train, val = F.col("split") == "train", F.col("split") == "validation"
    rows = trace(spark, data_dir).select(
        "digit",
        "epoch",
        "split",
        trace_loss().alias("loss"),
        ce_loss("logits", "label").alias("ce"),
        (argmax("logits") == F.col("label")).cast("int").alias("hit"),
    )
    return rows.groupBy(
        F.concat(F.lit("r"), F.col("digit").cast("string")).alias("run"), "epoch"
    ).agg(
        (F.count_if(train) * F.col("epoch")).cast("int").alias("step"),
        r6(F.avg(F.when(train, F.col("loss")))).alias("train_loss"),
        F.round(F.avg(F.when(val, F.col("ce"))), 1).alias("eval_loss"),
        (F.sum(F.when(val, F.col("hit"))) / F.count_if(val)).alias("val_acc"),
    )


# --- the same inputs in SQL ---------------------------------------------------------


def sql_r6(x: str) -> str:
    return f"(round({x}, 6) + 0.0::DOUBLE)"


def sql_split(key: str, seed: int = 42, fraction: float = 0.8) -> str:
    place = f"(('0x' || substr(md5({key} || ':{seed}'), 1, 8))::UBIGINT)::DOUBLE / 4294967296"
    return f"CASE WHEN {place} < {fraction} THEN 'train' ELSE 'validation' END"


SQL_LABELLED = f"""labelled AS (
  SELECT d.doc_id, d.text, l.toxic::INT AS label, {sql_split('md5(d.text)')} AS split
  FROM documents d JOIN labels l USING (doc_id))"""


def _sql_head(a: int, b: int, mod: int, half: int, j: int) -> str:
    return (
        f"list_transform(range({WIDTH}), lambda i: "
        f"((i * {a} + {b * j}) % {mod} - {half})::DOUBLE / {half})"
    )


SQL_TEACHER = [_sql_head(7, 13, 17, 8, j) for j in range(2)]
SQL_STUDENT = [_sql_head(5, 11, 13, 6, j) for j in range(2)]

SQL_SCORED = f"""vec AS (
  SELECT vec_id, label AS digit, (label % 2)::INT AS label,
         CASE WHEN vec_id % 5 = 0 THEN 'validation' ELSE 'train' END AS split,
         list_transform(embedding, lambda x: x::DOUBLE) AS v
  FROM embeddings),
scored AS (
  SELECT vec.*,
         list_dot_product(v, {SQL_TEACHER[0]}) AS t0, list_dot_product(v, {SQL_TEACHER[1]}) AS t1,
         list_dot_product(v, {SQL_STUDENT[0]}) AS s0, list_dot_product(v, {SQL_STUDENT[1]}) AS s1
  FROM vec)"""


def sql_log_softmax(a: str, b: str, temperature: float = 1.0) -> tuple[str, str]:
    za, zb = f"(({a}) / {temperature}::DOUBLE)", f"(({b}) / {temperature}::DOUBLE)"
    top = f"greatest({za}, {zb})"
    log_sum = f"ln(exp({za} - {top}) + exp({zb} - {top}))"
    return f"({za} - {top} - {log_sum})", f"({zb} - {top} - {log_sum})"


def sql_softmax(a: str, b: str, temperature: float = 1.0) -> tuple[str, str]:
    la, lb = sql_log_softmax(a, b, temperature)
    return f"exp({la})", f"exp({lb})"


def sql_pred(a: str, b: str) -> str:
    return f"(CASE WHEN ({b}) > ({a}) THEN 1 ELSE 0 END)"


def sql_ce(a: str, b: str, label: str = "label") -> str:
    la, lb = sql_log_softmax(a, b)
    return f"(-(CASE WHEN {label} = 1 THEN {lb} ELSE {la} END))"


def sql_kd(sa: str, sb: str, ta: str = "t0", tb: str = "t1", temperature: float = 4.0) -> str:
    s, t = sql_log_softmax(sa, sb, temperature), sql_log_softmax(ta, tb, temperature)
    terms = " + ".join(f"exp({x}) * ({x} - {y})" for x, y in zip(t, s))
    return f"({temperature * temperature} * ({terms}))"


SQL_TRACE = f"""{SQL_SCORED},
moved AS (
  SELECT vec_id, digit, label, split, t0, t1, e::INT AS epoch,
         s0 + (t0 - s0) * e / {TRACE_EPOCHS}::DOUBLE AS m0,
         s1 + (t1 - s1) * e / {TRACE_EPOCHS}::DOUBLE AS m1
  FROM scored, range(1, {TRACE_EPOCHS + 1}) r(e)),
trace AS (
  SELECT *, {sql_ce('m0', 'm1')} AS ce, {sql_ce('m0', 'm1')} + {sql_kd('m0', 'm1')} AS loss,
         {sql_pred('m0', 'm1')} AS pred
  FROM moved)"""

SQL_HISTORY = f"""{SQL_TRACE},
history AS (
  SELECT 'r' || digit AS run, epoch,
         (count(*) FILTER (split = 'train') * epoch)::INT AS step,
         {sql_r6("avg(loss) FILTER (split = 'train')")} AS train_loss,
         round(avg(ce) FILTER (split = 'validation'), 1) AS eval_loss,
         (sum((pred = label)::INT) FILTER (split = 'validation'))::DOUBLE
           / count(*) FILTER (split = 'validation') AS val_acc
  FROM trace GROUP BY digit, epoch)"""
