"""What must hold for any trained model, as rows that SQL can state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sensitext.constants import ID2LABEL
from sensitext.functions.scoring import argmax
from sensitext.operators.certificate import certificate
from sensitext.operators.integer_scorer import IntegerDetector
from sensitext.operators.metrics import compute_metrics
from sensitext.operators.predict import detect, predict
from sensitext.operators.train import evaluate
from sensitext.plans.inputs import SQL_LABELLED, documents, table
from sensitext.plans.model_queries import stream_texts, student, teacher
from sensitext.session import scratch_path
from sensitext.sources.models import load_model, save_model

_TINY = 1e-9
_FIELDS = ("非敏感", "敏感")


def _near(a: Column | str, b: Column | str) -> Column:
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.abs(a - b) < _TINY


def _records(held_out: DataFrame, model) -> DataFrame:
    """Prediction records of rows, with the checks that every one must pass."""
    records = predict(held_out, model, keep=("doc_id", "label", "split"))
    low, high = (F.col(f"probabilities.`{name}`") for name in _FIELDS)
    name = F.when(high > low, ID2LABEL[1]).otherwise(ID2LABEL[0])
    return records.select(
        "doc_id",
        "label",
        "split",
        _near(low + high, F.lit(1.0)).alias("sums_to_one"),
        (F.col("prediction") == name).alias("names_the_larger"),
        _near("confidence", F.greatest(low, high)).alias("confidence_is_larger"),
    )


def teacher_records(spark, data_dir):
    model, rows = teacher(spark, data_dir)
    return _records(rows.where(F.col("split") == "validation"), model)


def student_records(spark, data_dir):
    model, rows, _ = student(spark, data_dir)
    return _records(rows.where(F.col("split") == "validation"), model)


def model_roundtrip(spark, data_dir):
    """A saved and loaded detector decides like the fitted one, for every document."""
    model, _ = teacher(spark, data_dir)
    path = scratch_path(spark, "saved-model")
    save_model(model, path)
    docs = documents(spark, data_dir)
    a = detect(docs, model, keep=("doc_id",))
    b = detect(docs, load_model(path), keep=("doc_id",)).select(
        "doc_id",
        F.col("confidence").alias("b_confidence"),
        F.col("is_sensitive").alias("b_sensitive"),
    )
    return a.join(b, "doc_id").select(
        "doc_id",
        _near("confidence", "b_confidence").alias("same_confidence"),
        (F.col("is_sensitive") == F.col("b_sensitive")).alias("same_decision"),
        F.col("is_sensitive").eqNullSafe(F.col("label") == 1).alias("decision_is_label"),
    )


def stream_equals_batch(spark, data_dir):
    """Streamed conversation turns get the answers of a batch."""
    model, _ = teacher(spark, data_dir)
    turns = table(spark, data_dir, "conversations", "conv_id", "turn", "text")
    batch = detect(turns, model, keep=("conv_id", "turn")).select(
        "conv_id",
        "turn",
        F.col("label").alias("b_label"),
        F.col("confidence").alias("b_confidence"),
    )
    return (
        stream_texts(spark, data_dir)
        .join(batch, ["conv_id", "turn"])
        .select(
            "conv_id",
            "turn",
            (F.col("label") == F.col("b_label")).alias("same_label"),
            _near("confidence", "b_confidence").alias("same_confidence"),
        )
    )


def evaluate_recomputed(spark, data_dir):
    """The metrics of ``evaluate`` are those of the stored predictions, per split."""
    model, rows = teacher(spark, data_dir)
    scored = model.score(rows).select("split", "label", argmax("logits").alias("pred"))
    names = ("eval_accuracy", "eval_precision", "eval_recall", "eval_f1")
    again = compute_metrics(scored, "split").withColumnsRenamed({c: f"b_{c}" for c in names})
    sizes = scored.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))
    checks = [_near(c, f"b_{c}").alias(c) for c in names]
    return (
        evaluate(model, rows)
        .join(again, "split")
        .join(sizes, "split")
        .select("split", "n_rows", *checks, (F.col("eval_loss") >= 0).alias("eval_loss"))
    )


def teacher_optimality(spark, data_dir):
    """The teacher's weights are those that its training rows ask for, within the tolerance."""
    model, rows = teacher(spark, data_dir)
    checked = certificate(model, rows.where(F.col("split") == "train"))
    # Only the intercept is met in every row.
    n_rows = F.when(F.col("kind") == "intercept", F.col("n_rows"))
    return checked.select("kind", n_rows.alias("n_rows"), "holds")


def int8_detector(spark, data_dir):
    """Over all documents, the teacher in int8 keeps within the bounds of its rounding."""
    model, _ = teacher(spark, data_dir)
    encoded = model.encode(documents(spark, data_dir)).select("doc_id", "input_ids")
    full = model.score_encoded(encoded).withColumnRenamed("logits", "full")
    both = IntegerDetector.of(model).score_encoded(full, detail=True)
    return both.select("doc_id", *int8_checks())


def int8_checks(full: str = "full") -> list[Column]:
    """What holds for ``logits`` and ``bounds`` beside the logits of the full weights.

    Other decisions than the full ones are open only where their margin is within the bounds.
    """
    at = [[F.element_at(c, j + 1) for j in range(2)] for c in (full, "logits", "bounds")]
    (f0, f1), (i0, i1), (b0, b1) = at
    near = (F.abs(f0 - i0) <= b0 + _TINY) & (F.abs(f1 - i1) <= b1 + _TINY)
    open_margin = F.abs(f1 - f0) <= b0 + b1 + 2 * _TINY
    same = argmax(full) == argmax("logits")
    return [near.alias("within_bounds"), (same | open_margin).alias("decision_is_founded")]


QUERIES = {
    "teacher_records": teacher_records,
    "student_records": student_records,
    "model_roundtrip": model_roundtrip,
    "stream_equals_batch": stream_equals_batch,
    "evaluate_recomputed": evaluate_recomputed,
    "teacher_optimality": teacher_optimality,
    "int8_detector": int8_detector,
}

_RECORDS = f"""WITH {SQL_LABELLED} SELECT doc_id, label, split, true AS sums_to_one,
    true AS names_the_larger, true AS confidence_is_larger
    FROM labelled WHERE split = 'validation'"""

ORACLE = {
    "teacher_records": _RECORDS,
    "student_records": _RECORDS,
    "model_roundtrip": """SELECT doc_id, true AS same_confidence, true AS same_decision,
        true AS decision_is_label FROM documents""",
    "stream_equals_batch": """SELECT conv_id, turn, true AS same_label, true AS same_confidence
        FROM conversations""",
    "evaluate_recomputed": f"""WITH {SQL_LABELLED} SELECT split, count(*) AS n_rows,
        true AS eval_accuracy, true AS eval_precision, true AS eval_recall, true AS eval_f1,
        true AS eval_loss FROM labelled GROUP BY split""",
    "teacher_optimality": f"""WITH {SQL_LABELLED} SELECT kind,
        CASE kind WHEN 'intercept' THEN n END AS n_rows, true AS holds
        FROM (SELECT count(*) AS n FROM labelled WHERE split = 'train'),
          (VALUES ('intercept'), ('used'), ('zero')) k(kind)""",
    "int8_detector": """SELECT doc_id, true AS within_bounds, true AS decision_is_founded
        FROM documents""",
}
