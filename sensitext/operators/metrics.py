"""Classification metrics and training-loss averages; each is one aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sensitext.constants import LOG_EVERY
from sensitext.functions.losses import ce_loss
from sensitext.functions.numeric import ratio_or_zero, round4
from sensitext.functions.scoring import argmax


def _counts(label: str, pred: str, positive: int) -> dict[str, Column]:
    actual, guess = F.col(label) == positive, F.col(pred) == positive
    return {
        "tp": F.count_if(actual & guess),
        "fp": F.count_if(~actual & guess),
        "fn": F.count_if(actual & ~guess),
        "tn": F.count_if(~actual & ~guess),
    }


def _group(df: DataFrame, by: str | Sequence[str] | None):
    return df.groupBy(*([by] if isinstance(by, str) else list(by or [])))


def confusion(
    df: DataFrame,
    by: str | Sequence[str] | None = None,
    label: str = "label",
    pred: str = "pred",
    positive: int = 1,
) -> DataFrame:
    """Counts ``tp, fp, fn, tn``."""
    counts = _counts(label, pred, positive)
    return _group(df, by).agg(*[c.alias(n) for n, c in counts.items()])


def accuracy(
    df: DataFrame,
    by: str | Sequence[str] | None = None,
    label: str = "label",
    pred: str = "pred",
) -> DataFrame:
    """Share of rows whose prediction equals the label; null without rows."""
    same = (F.col(label) == F.col(pred)).cast("double")
    return _group(df, by).agg(F.avg(same).alias("accuracy"))


def precision_recall_f1(
    df: DataFrame,
    by: str | Sequence[str] | None = None,
    label: str = "label",
    pred: str = "pred",
    positive: int = 1,
) -> DataFrame:
    """Precision, recall and F1 of one class; a zero denominator gives 0."""
    c = _counts(label, pred, positive)
    return _group(df, by).agg(*_precision_recall_f1(c))


def _precision_recall_f1(c: dict[str, Column]) -> list[Column]:
    return [
        ratio_or_zero(c["tp"], c["tp"] + c["fp"]).alias("precision"),
        ratio_or_zero(c["tp"], c["tp"] + c["fn"]).alias("recall"),
        ratio_or_zero(2 * c["tp"], 2 * c["tp"] + c["fp"] + c["fn"]).alias("f1"),
    ]


def compute_metrics(
    df: DataFrame,
    by: str | Sequence[str] | None = None,
    label: str = "label",
    pred: str = "pred",
    positive: int = 1,
) -> DataFrame:
    """The four metrics, rounded to four digits, in one pass over the rows."""
    return _group(df, by).agg(*metric_columns(label, pred, positive))


def metric_columns(label: str = "label", pred: str = "pred", positive: int = 1) -> list[Column]:
    """The four metrics as aggregates, for use next to others in one ``agg``."""
    same = F.avg((F.col(label) == F.col(pred)).cast("double"))
    precision, recall, f1 = _precision_recall_f1(_counts(label, pred, positive))
    return [
        round4(same).alias("eval_accuracy"),
        round4(precision).alias("eval_precision"),
        round4(recall).alias("eval_recall"),
        round4(f1).alias("eval_f1"),
    ]


def eval_loss(
    df: DataFrame,
    by: str | Sequence[str] | None = None,
    logits: str = "logits",
    label: str = "label",
) -> DataFrame:
    """Mean cross-entropy."""
    return _group(df, by).agg(F.avg(ce_loss(logits, label)).alias("eval_loss"))


def epoch_loss(df: DataFrame, loss: str = "loss") -> DataFrame:
    """Mean of batch means per epoch, so that a short last batch weighs the same."""
    batches = df.groupBy("epoch", "batch_id").agg(F.avg(loss).alias("_batch_loss"))
    return batches.groupBy("epoch").agg(F.avg("_batch_loss").alias("train_loss"))


def val_accuracy_by_epoch(df: DataFrame, logits: str = "logits", label: str = "label") -> DataFrame:
    """Correct rows over all rows per epoch."""
    correct = F.sum((argmax(logits) == F.col(label)).cast("long"))
    total = F.count(F.lit(1))
    return df.groupBy("epoch").agg(
        correct.alias("correct"), total.alias("total"), (correct / total).alias("val_acc")
    )


def log_rollup(history: DataFrame, every: int = LOG_EVERY, loss: str = "train_loss") -> DataFrame:
    """One row per run and ``every`` steps: last step and mean loss."""
    window = F.floor((F.col("step") - 1) / every).cast("int")
    return history.groupBy("run", window.alias("log_row")).agg(
        F.max("step").alias("step"), F.avg(loss).alias("train_loss")
    )


def compare_models(
    df: DataFrame,
    by: str = "split",
    label: str = "label",
    teacher: str = "t_logits",
    student: str = "s_logits",
) -> DataFrame:
    """Accuracy of teacher and student on the same rows, and the drop."""
    t = F.avg((argmax(teacher) == F.col(label)).cast("double"))
    s = F.avg((argmax(student) == F.col(label)).cast("double"))
    return df.groupBy(by).agg(
        t.alias("teacher_accuracy"), s.alias("student_accuracy"), (t - s).alias("drop")
    )
