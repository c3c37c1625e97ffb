"""Scoring frames: from texts or vectors to labels, confidences and decisions.

A *scorer* is any function that takes a frame and adds an array column ``logits``.
``linear_scorer`` and ``Detector.score`` are scorers; ``batch_scorer`` makes one of any
model that works on NumPy batches.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame, functions as F, types as T

from sensitext.constants import ID2LABEL, THRESHOLD
from sensitext.functions.scoring import (
    argmax,
    confidence,
    decide,
    has_nan,
    label_map_column,
    label_name,
    linear_logits,
    prob_struct,
    softmax,
)

Scorer = Callable[[DataFrame], DataFrame]
# A text is hot if it fills more than one in so many rows, and so many rows at least.
_HOT_VALUES = 10_000
_HOT_ROWS = 10_000


def linear_score(
    df: DataFrame, vec_col: str, heads: Sequence[Sequence[float]], out: str = "logits"
) -> DataFrame:
    """Add the logits of a linear head over a vector column."""
    return df.withColumn(out, linear_logits(vec_col, heads))


def linear_scorer(vec_col: str, heads: Sequence[Sequence[float]]) -> Scorer:
    return lambda df: linear_score(df, vec_col, heads)


def batch_scorer(
    make_predict: Callable,
    inputs: Sequence[str],
    input_shapes: Sequence[Sequence[int] | None],
    batch_size: int = 32,
) -> Scorer:
    """A scorer around an outside model, loaded once per Python worker.

    ``make_predict`` loads the model and returns a function over NumPy batches; inputs
    such as padded ``input_ids`` must have the fixed shapes given.
    """
    run = predict_batch_udf(
        make_predict,
        return_type=T.ArrayType(T.FloatType()),
        batch_size=batch_size,
        input_tensor_shapes=list(input_shapes),
    )
    return lambda df: df.withColumn("logits", run(*inputs).cast("array<double>"))


def score(df: DataFrame, model, out: str = "logits") -> DataFrame:
    """Add logits by a scorer, or by a model that has a ``score`` method.

    A column ``out`` that is there already is replaced; other columns stay as they are.
    """
    add = model if callable(model) else model.score
    if out == "logits":
        return add(df.drop("logits"))
    kept = df.drop(out).withColumnRenamed("logits", "_kept_logits")
    scored = add(kept).withColumnRenamed("logits", out)
    return scored.withColumnRenamed("_kept_logits", "logits")


def nan_guard(df: DataFrame, logits_col: str = "logits") -> DataFrame:
    """Add ``had_nan, label, confidence, probs``; a row with a NaN logit gets the neutral answer.

    Neutral means label 0, confidence 0.0 and even probabilities.
    """
    nan = F.coalesce(has_nan(logits_col), F.lit(False))
    size = F.size(logits_col)
    even = F.array_repeat(F.lit(1.0) / size, size)
    guarded = df.withColumn("had_nan", nan).withColumn(
        "probs", F.when(F.col("had_nan"), even).otherwise(softmax(logits_col))
    )
    guarded = guarded.withColumn(
        "label", F.when(F.col("had_nan"), F.lit(0)).otherwise(argmax("probs"))
    )
    return guarded.withColumn(
        "confidence",
        F.when(F.col("had_nan"), F.lit(0.0)).otherwise(confidence("probs", "label")),
    )


def predictions(
    scored: DataFrame,
    keep: Sequence[str] = ("text",),
    id2label: Mapping[int, str] = ID2LABEL,
    logits_col: str = "logits",
) -> DataFrame:
    """Prediction records of scored rows: ``keep``, prediction, confidence, probabilities.

    Kept columns stay as they are, a true ``label`` too; a kept column may not have the name of
    a new one.
    """
    kept, guarded = _guarded(scored, keep, logits_col, ("prediction", "confidence", "probabilities"))
    names = [name for _, name in sorted(id2label.items())]
    return guarded.select(
        *kept,
        label_name("label", label_map_column(id2label)).alias("prediction"),
        "confidence",
        prob_struct("probs", names).alias("probabilities"),
    )


def detections(
    scored: DataFrame,
    keep: Sequence[str] = (),
    threshold: float = THRESHOLD,
    logits_col: str = "logits",
) -> DataFrame:
    """Short records of scored rows: ``keep``, label, confidence, is_sensitive.

    A kept column may not have the name of a new one.
    """
    kept, guarded = _guarded(scored, keep, logits_col, ("label", "confidence", "is_sensitive"))
    return guarded.select(
        *kept, "label", "confidence", decide("probs", threshold).alias("is_sensitive")
    )


def _guarded(
    scored: DataFrame, keep: Sequence[str], logits_col: str, new: Sequence[str]
) -> tuple[list[Column], DataFrame]:
    """The guard's columns beside one struct of the kept ones, and the kept ones out of it."""
    if clash := set(keep) & set(new):
        raise ValueError(f"kept columns {sorted(clash)} have the names of new ones")
    logits = F.col(logits_col).alias("_logits")
    rows = scored.select(*([F.struct(*keep).alias("_kept")] if keep else []), logits)
    return [F.col(f"_kept.`{name}`") for name in keep], nan_guard(rows, "_logits")


def predict(df: DataFrame, model, keep: Sequence[str] = ("text",)) -> DataFrame:
    """Score texts and return prediction records."""
    return predictions(score(df, model), keep, getattr(model, "id2label", ID2LABEL))


def detect(
    df: DataFrame, model, keep: Sequence[str] = (), threshold: float = THRESHOLD
) -> DataFrame:
    """Score texts and return short records."""
    return detections(score(df, model), keep, threshold)


def predict_probes(probes: DataFrame, model) -> DataFrame:
    """How often each kind of probe text gets each prediction: ``kind, prediction, n``."""
    return (
        predict(probes, model, keep=("kind",))
        .groupBy("kind", "prediction")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def hot_values(
    df: DataFrame, key: str, top: int = _HOT_VALUES, min_rows: int = _HOT_ROWS
) -> DataFrame:
    """Hashes of values that fill more than one in ``top`` rows, so fewer than ``top`` rows.

    Values with fewer than ``min_rows`` copies do not count.

    One pass with a frequent-items sketch of fixed size. An inexact sketch is harmless: the
    result only decides which rows are spread over more tasks.
    """
    hashed = df.select(F.xxhash64(key).alias("h"))
    row = hashed.agg(
        F.expr(f"approx_top_k(h, {top}, {10 * top})").alias("top"), F.count(F.lit(1)).alias("n")
    ).first()
    least = max(min_rows, row.n // top + 1)
    hot = [(found["item"],) for found in row.top or [] if found["count"] >= least]
    return df.sparkSession.createDataFrame(hot, "_hash bigint")


def score_distinct(
    df: DataFrame, model, key: str = "text", keep: Sequence[str] | None = None
) -> DataFrame:
    """Score each distinct text once and give every copy the result; null counts as a text.

    Worth its shuffles for a heavy model. One scan: each task folds its copies of a text into one
    cell, which holds the text once and what is kept of its rows, so a cell is never larger than
    what a task reads. Verdicts come from the cells by digest and go back to them by digest and
    task; copies of a hot text stay spread, as they have a cell in every task that read one.
    """
    # Never null, so that the optimizer adds no null check to one use of the cells alone.
    digest: Column = F.coalesce(F.sha2(F.col(key), 256), F.lit(""))
    keep = list(df.columns) if keep is None else list(keep)
    # The text stands in the cell already; a row without other columns is an empty mark.
    others = [F.col(c) for c in keep if c != key] or [F.lit(True).alias("_mark")]
    cells = (
        df.select(
            digest.alias("_digest"),
            F.spark_partition_id().alias("_task"),
            F.col(key).alias("_text"),
            F.struct(*others).alias("_row"),
        )
        .groupBy("_digest", "_task")
        .agg(F.min("_text").alias("_text"), F.collect_list("_row").alias("_rows"))
        # Always true. As it asks for both columns, both uses have the same shuffle, which Spark
        # then makes once; pruned apart they would be two scans.
        .where("size(_rows) > 0 AND (_text IS NULL OR length(_text) >= 0)")
    )
    unique = cells.groupBy("_digest").agg(
        F.min("_text").alias(key), F.collect_set("_task").alias("_tasks")
    )
    verdicts = score(unique, model).select(
        "_digest", F.explode("_tasks").alias("_task"), "logits"
    )
    rows = cells.join(verdicts, ["_digest", "_task"], "left").select(
        "_text", "logits", F.explode("_rows").alias("_row")
    )
    return rows.select(
        *[(F.col("_text") if c == key else F.col(f"_row.`{c}`")).alias(c) for c in keep], "logits"
    )
