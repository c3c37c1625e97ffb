"""Queries over sources, preparation and profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensitext.functions.scoring import label_name
from sensitext.functions.text import basic_tokens
from sensitext.operators.prep import (
    assign_batches,
    coerce_label,
    coerce_text,
    hash_split,
    prune,
)
from sensitext.operators.profile import column_report, label_distribution, split_sizes
from sensitext.plans.inputs import (
    SQL_LABELLED,
    documents,
    labelled,
    r6,
    sql_r6,
    sql_split,
    table,
)
from sensitext.plans.text_sql import sql_tokens


def labelled_join(spark, data_dir):
    return labelled(spark, data_dir).select("doc_id", "text", "label", "split")


def label_map(spark, data_dir):
    labels = table(spark, data_dir, "labels", "doc_id", F.col("toxic").alias("label"))
    return labels.select("doc_id", "label", label_name("label").alias("label_name"))


def coerce_text_query(spark, data_dir):
    gaps = documents(spark, data_dir).withColumn(
        "text", F.when(F.col("doc_id") % 11 != 0, F.col("text"))
    )
    return coerce_text(gaps).select("doc_id", "text")


def coerce_label_query(spark, data_dir):
    labels = table(spark, data_dir, "labels")
    sign = F.when(F.col("doc_id") % 3 == 0, "-").otherwise("")
    written = F.concat(
        sign, F.col("toxic").cast("string"), F.lit("."), (F.col("doc_id") % 10).cast("string")
    )
    return coerce_label(labels.select("doc_id", written.alias("label")))


def hash_split_query(spark, data_dir):
    return hash_split(documents(spark, data_dir)).select("doc_id", "split")


def prune_query(spark, data_dir):
    docs = table(spark, data_dir, "documents", spread=True)
    counted = docs.withColumn("n_tokens", F.size(basic_tokens("text")))
    return prune(counted, drop=("text", "n_chars", "source"))


def assign_batches_query(spark, data_dir):
    ids = table(spark, data_dir, "documents", "doc_id")
    return assign_batches(ids, 32, "doc_id", epochs=[1, 2])


def ordered_batches(spark, data_dir):
    ids = table(spark, data_dir, "documents", "doc_id")
    return assign_batches(ids, 32, "doc_id", shuffle=False)


def split_sizes_query(spark, data_dir):
    return split_sizes(labelled(spark, data_dir))


def column_report_query(spark, data_dir):
    return column_report(labelled(spark, data_dir).select("doc_id", "text", "label", "split"))


def label_distribution_query(spark, data_dir):
    return label_distribution(labelled(spark, data_dir)).withColumn("share", r6("share"))


QUERIES = {
    "labelled_join": labelled_join,
    "label_map": label_map,
    "coerce_text": coerce_text_query,
    "coerce_label": coerce_label_query,
    "hash_split": hash_split_query,
    "prune": prune_query,
    "assign_batches": assign_batches_query,
    "ordered_batches": ordered_batches,
    "split_sizes": split_sizes_query,
    "column_report": column_report_query,
    "label_distribution": label_distribution_query,
}

ORACLE = {
    "labelled_join": f"WITH {SQL_LABELLED} SELECT doc_id, text, label, split FROM labelled",
    "label_map": """SELECT doc_id, toxic AS label,
        CASE toxic WHEN 0 THEN '非敏感' WHEN 1 THEN '敏感' END AS label_name FROM labels""",
    "coerce_text": """SELECT doc_id, CASE WHEN doc_id % 11 != 0 THEN text ELSE 'nan' END AS text
        FROM documents""",
    "coerce_label": """SELECT doc_id, trunc((CASE WHEN doc_id % 3 = 0 THEN '-' ELSE '' END
        || toxic || '.' || (doc_id % 10))::DOUBLE)::INT AS label FROM labels""",
    "hash_split": f"SELECT doc_id, {sql_split('md5(text)')} AS split FROM documents",
    "prune": f"""SELECT doc_id, lang, len({sql_tokens('text')})::INT AS n_tokens
        FROM documents""",
    "assign_batches": """WITH k AS (
          SELECT doc_id, e::INT AS epoch, row_number() OVER (
            PARTITION BY e ORDER BY md5(doc_id || ':42:' || e), doc_id) - 1 AS row_index
          FROM documents, range(1, 3) r(e))
        SELECT doc_id, epoch, row_index, row_index // 32 AS batch_id FROM k""",
    "ordered_batches": """WITH k AS (
          SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_index FROM documents)
        SELECT doc_id, 1::INT AS epoch, row_index, row_index // 32 AS batch_id FROM k""",
    "split_sizes": f"""WITH {SQL_LABELLED}
        SELECT split, count(*) AS n_rows FROM labelled GROUP BY split""",
    "column_report": f"""WITH {SQL_LABELLED},
        cols AS (SELECT * FROM (VALUES (0::INT, 'doc_id', 'bigint'), (1::INT, 'text', 'string'),
          (2::INT, 'label', 'int')) c("position", "name", "type"))
        SELECT split, "position", "name", "type", n_rows
        FROM (SELECT split, count(*) AS n_rows FROM labelled GROUP BY split), cols""",
    "label_distribution": f"""WITH {SQL_LABELLED},
        n AS (SELECT split, label, count(*) AS n_rows FROM labelled
              WHERE label IS NOT NULL GROUP BY split, label)
        SELECT split, label, n_rows,
          {sql_r6('n_rows::DOUBLE / sum(n_rows) OVER (PARTITION BY split)')} AS share FROM n""",
}
