"""Round trips of the sources and sinks over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensitext.constants import ENCODE_BATCH
from sensitext.operators.predict import linear_scorer, predict
from sensitext.operators.prep import coerce_label, map_batches
from sensitext.plans.inputs import (
    SQL_HISTORY,
    SQL_LABELLED,
    SQL_SCORED,
    TEACHER_HEADS,
    documents,
    history,
    labelled,
    r6,
    sql_pred,
    sql_r6,
    sql_softmax,
    vectors,
)
from sensitext.session import scratch_path
from sensitext.sources.csv_blocks import read_labelled_blocks
from sensitext.sources.labelled import load_splits, write_splits
from sensitext.sources.sinks import append_history, read_history, write_predictions


def _written_csv(spark, data_dir):
    """The path of the labelled texts as CSV."""
    raw = scratch_path(spark, "labelled-csv")
    writer = labelled(spark, data_dir).select("text", "label").write.option("header", True)
    for side in ("Leading", "Trailing"):
        writer = writer.option(f"ignore{side}WhiteSpace", False)
    writer.option("escape", '"').csv(raw)
    return raw


def csv_splits(spark, data_dir):
    """Labelled texts written as one CSV, split into two, and read back whole."""
    raw, split = _written_csv(spark, data_dir), scratch_path(spark, "split-csv")
    write_splits(spark, raw, split)
    rows = coerce_label(load_splits(spark, split))
    # Copies of a text may bear different labels, so both are grouped by.
    return rows.groupBy("split", "label", F.md5("text").alias("digest")).agg(
        F.count(F.lit(1)).alias("n")
    )


def csv_blocks(spark, data_dir):
    """Labelled texts written as CSV and read back by blocks."""
    rows = coerce_label(read_labelled_blocks(spark, _written_csv(spark, data_dir)))
    return rows.groupBy("label", F.md5("text").alias("digest")).agg(F.count(F.lit(1)).alias("n"))


def prediction_files(spark, data_dir):
    """Prediction records written as Parquet and as JSON, read back and put side by side."""
    records = predict(
        vectors(spark, data_dir), linear_scorer("embedding", TEACHER_HEADS), keep=("vec_id",)
    ).select("vec_id", "prediction", "confidence")
    folder = scratch_path(spark, "prediction-files")
    for fmt in ("parquet", "json"):
        write_predictions(records, f"{folder}/{fmt}", fmt)
    stored = spark.read.schema(records.schema).parquet(f"{folder}/parquet")
    lines = spark.read.schema(records.schema).json(f"{folder}/json")
    names = {c: f"json_{c}" for c in ("prediction", "confidence")}
    return stored.join(lines.withColumnsRenamed(names), "vec_id").select(
        "vec_id", "prediction", "json_prediction", *[r6(c).alias(c) for c in ("confidence", "json_confidence")]
    )


def history_appends(spark, data_dir):
    """A history appended in two parts and read as one."""
    path = scratch_path(spark, "history")
    rows = history(spark, data_dir)
    append_history(spark, rows.where("epoch <= 3"), path)
    append_history(spark, rows.where("epoch > 3"), path)
    return read_history(spark, path).select(
        "run", "epoch", "step", "train_loss", "eval_loss", r6("val_acc").alias("val_acc")
    )


def batch_lengths(spark, data_dir):
    """A pandas function over batches keeps every row."""

    def lengths(frame):
        return frame.assign(n=frame["text"].fillna("").str.len(), small=len(frame) <= ENCODE_BATCH)[
            ["doc_id", "n", "small"]
        ]

    return map_batches(documents(spark, data_dir), lengths, "doc_id bigint, n bigint, small boolean")


QUERIES = {
    "csv_splits": csv_splits,
    "csv_blocks": csv_blocks,
    "prediction_files": prediction_files,
    "history_appends": history_appends,
    "batch_lengths": batch_lengths,
}

_CONFIDENCE = sql_r6(f"greatest({', '.join(sql_softmax('t0', 't1'))})")
_NAME = f"CASE {sql_pred('t0', 't1')} WHEN 1 THEN '敏感' ELSE '非敏感' END"

ORACLE = {
    "csv_splits": f"""WITH {SQL_LABELLED} SELECT split, label, md5(text) AS digest, count(*) AS n
        FROM labelled GROUP BY ALL""",
    "csv_blocks": f"""WITH {SQL_LABELLED} SELECT label, md5(text) AS digest, count(*) AS n
        FROM labelled GROUP BY ALL""",
    "prediction_files": f"""WITH {SQL_SCORED} SELECT vec_id, {_NAME} AS prediction,
        {_NAME} AS json_prediction, {_CONFIDENCE} AS confidence, {_CONFIDENCE} AS json_confidence
        FROM scored""",
    "history_appends": f"""WITH {SQL_HISTORY} SELECT run, epoch, step, train_loss, eval_loss,
        {sql_r6('val_acc')} AS val_acc FROM history""",
    "batch_lengths": """SELECT doc_id, length(coalesce(text, '')) AS n, true AS small
        FROM documents""",
}
