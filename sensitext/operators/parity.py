"""How far a compressed scorer drifts from the full one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from sensitext.constants import PARITY_TOLERANCE
from sensitext.functions.compress import logit_diff
from sensitext.functions.scoring import argmax, softmax
from sensitext.operators.predict import score


def parity_verdict(
    df: DataFrame, a: str = "a_logits", b: str = "b_logits", tol: float = PARITY_TOLERANCE
) -> DataFrame:
    """Add ``max_diff`` and ``consistent``; a difference equal to the tolerance is too large."""
    return df.withColumn("max_diff", logit_diff(a, b)).withColumn(
        "consistent", F.col("max_diff") < F.lit(tol)
    )


def agreement(
    a: DataFrame, b: DataFrame | None = None, key: str | None = None
) -> DataFrame:
    """How often ``a_pred`` meets ``b_pred``: ``a_pred, b_pred, n, share``.

    Predictions of two separate frames are paired by ``key``; those of one frame are
    taken as they stand, without a join.
    """
    pairs = a if b is None else a.join(b, key, "inner")
    counts = pairs.groupBy("a_pred", "b_pred").agg(F.count(F.lit(1)).alias("n"))
    # One row per pair of classes is left here, so one window over all of them is small.
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))
    return counts.withColumn("share", F.col("n") / total)


def parity_report(
    df: DataFrame,
    model_a,
    model_b,
    keep: Sequence[str] = ("text",),
    tol: float = PARITY_TOLERANCE,
) -> DataFrame:
    """Both scorers over the same rows, side by side: one row per text.

    The second scorer reads the frame the first one made, so nothing is joined.
    """
    both = score(score(df, model_a, "a_logits"), model_b, "b_logits")
    narrow = both.select(*keep, "a_logits", "b_logits")
    shown = (
        narrow.withColumn("a_probs", softmax("a_logits"))
        .withColumn("b_probs", softmax("b_logits"))
        .withColumn("a_pred", argmax("a_logits"))
        .withColumn("b_pred", argmax("b_logits"))
    )
    return parity_verdict(shown, tol=tol)


def parity_summary(report: DataFrame) -> DataFrame:
    """One row over a parity report: texts, agreement, consistency and largest difference."""
    return report.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((F.col("a_pred") == F.col("b_pred")).cast("double")).alias("agreement"),
        F.count_if("consistent").alias("n_consistent"),
        F.max("max_diff").alias("max_diff"),
    )
