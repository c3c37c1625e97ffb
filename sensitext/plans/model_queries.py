"""Queries that train a model on the labelled table.

Their rows depend on the fit, so they have no SQL twin; ``trained_checks`` states what must
hold for them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sensitext.operators.distill import fit_student, soft_labels
from sensitext.operators.integer_scorer import IntegerDetector
from sensitext.operators.parity import parity_report, parity_summary
from sensitext.operators.predict import detect, predict, predict_probes
from sensitext.operators.encoding import build_vocab, vocab_dict
from sensitext.operators.prep import hash_split
from sensitext.operators.train import Detector, evaluate, fit_teacher
from sensitext.plans.inputs import SCHEMAS, documents, labelled_ids, table
from sensitext.session import scratch_path
from sensitext.streaming.score_stream import read_stream, score_stream

# A linear student starts from nothing, so it needs a larger rate than a tuned transformer.
STUDENT = {
    "epochs": 20,
    "lr": 0.4,
    "workers": 4,
    "kd_weight": 2.0,
    "sparsity": 0.3,
    "min_rows": 30,
    "balanced": True,
}
# Detectors of this process: their number is that of sessions and folders, and each is as small
# as its vocabulary.
_teachers: dict[tuple[str, str], Detector] = {}


def teacher(spark: SparkSession, data_dir: str) -> tuple[Detector, DataFrame]:
    """A detector fitted on the training split, and the whole labelled frame, encoded.

    Fitted once per session and folder; the vocabulary comes from documents that the split
    by content gives to training.
    """
    key = (spark.sparkContext.applicationId, data_dir)
    if key in _teachers:
        model = _teachers[key]
        return model, labelled_ids(spark, data_dir, model.vocab)
    docs = hash_split(documents(spark, data_dir))
    vocab = vocab_dict(build_vocab(docs.where(F.col("split") == "train")))
    # Encoded once for the fit and for what is asked of the model.
    rows = labelled_ids(spark, data_dir, vocab, store=True)
    _teachers[key] = fit_teacher(rows.where(F.col("split") == "train"), vocab)
    return _teachers[key], rows


def teacher_predict(spark, data_dir):
    """Encode, train, and score the texts that were held out."""
    model, rows = teacher(spark, data_dir)
    held_out = rows.where(F.col("split") == "validation")
    return predict(held_out, model, keep=("doc_id", "label"))


def evaluate_model(spark, data_dir):
    model, rows = teacher(spark, data_dir)
    return evaluate(model, rows)


def student(spark: SparkSession, data_dir: str) -> tuple[Detector, DataFrame, list[tuple]]:
    """A linear student distilled from the teacher's soft labels."""
    model, rows = teacher(spark, data_dir)
    encoded = rows.select("doc_id", "label", "split", "input_ids")
    soft = soft_labels(encoded, model.score_encoded)
    fitted, steps = fit_student(soft, run="distil", **STUDENT)
    return Detector(fitted, model.vocab, model.max_length, model.id2label), rows, steps


def student_predict(spark, data_dir):
    model, rows, _ = student(spark, data_dir)
    held_out = rows.where(F.col("split") == "validation")
    return predict(held_out, model, keep=("doc_id", "label"))


def probe_report(spark, data_dir):
    """Predictions of conversation turns, counted by role."""
    model, _ = teacher(spark, data_dir)
    turns = table(spark, data_dir, "conversations", F.col("role").alias("kind"), "text")
    return predict_probes(turns, model)


def detect_texts(spark, data_dir):
    """The detector over every document."""
    model, _ = teacher(spark, data_dir)
    return detect(documents(spark, data_dir), model, keep=("doc_id",))


def int8_parity(spark, data_dir):
    """The fitted teacher against itself in int8, over every document."""
    model, _ = teacher(spark, data_dir)
    # Encoded once for both scorers.
    encoded = model.encode(documents(spark, data_dir)).select("doc_id", "input_ids")
    return parity_summary(parity_report(encoded, model, IntegerDetector.of(model), ("doc_id",)))


def stream_texts(spark, data_dir):
    """The detector over conversation turns that arrive as a stream."""
    model, _ = teacher(spark, data_dir)
    source = f"{data_dir}/conversations.[p]arquet"
    stream = read_stream(spark, source, SCHEMAS["conversations"])
    sink = scratch_path(spark, "stream-texts")
    query = score_stream(
        stream, model, f"{sink}/out", f"{sink}/checkpoint", keep=("conv_id", "turn")
    )
    query.awaitTermination()
    return spark.read.schema(
        "conv_id bigint, turn bigint, label int, confidence double, is_sensitive boolean"
    ).parquet(f"{sink}/out")


QUERIES = {
    "teacher_predict": teacher_predict,
    "evaluate_model": evaluate_model,
    "student_predict": student_predict,
    "probe_report": probe_report,
    "detect_texts": detect_texts,
    "int8_parity": int8_parity,
    "stream_texts": stream_texts,
}
