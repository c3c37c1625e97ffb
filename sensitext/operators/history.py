"""Choices over training history: ``run, epoch, step, train_loss, eval_loss, val_acc``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from sensitext.constants import CHECKPOINT_LIMIT


def best_by_loss(history: DataFrame) -> DataFrame:
    """Epoch with the lowest evaluation loss per run; the first one wins a tie."""
    best = F.min(F.struct("eval_loss", "epoch"))
    return (
        history.where(F.col("eval_loss").isNotNull())
        .groupBy("run")
        .agg(best.alias("b"))
        .select("run", "b.epoch", "b.eval_loss")
    )


def best_by_accuracy(history: DataFrame) -> DataFrame:
    """Epoch with the highest validation accuracy per run; the last one wins a tie."""
    best = F.max(F.struct("val_acc", "epoch"))
    return (
        history.where(F.col("val_acc").isNotNull())
        .groupBy("run")
        .agg(best.alias("b"))
        .select("run", "b.epoch", "b.val_acc")
    )


def is_new_best(history: DataFrame) -> DataFrame:
    """Flag each epoch whose accuracy is not below any earlier one, starting from 0.0."""
    earlier = (
        Window.partitionBy("run")
        .orderBy("epoch")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    bar = F.coalesce(F.max("val_acc").over(earlier), F.lit(0.0))
    return history.withColumn("is_new_best", F.col("val_acc") >= bar)


def retained(history: DataFrame, limit: int = CHECKPOINT_LIMIT) -> DataFrame:
    """Checkpoints kept on disk: the best by loss, then the latest ones up to ``limit``.

    The best epochs are joined by run and epoch, which spreads a long run over many
    tasks, and only the ``limit`` first rows of a run reach the final ranking.
    """
    best = best_by_loss(history).select("run", "epoch", F.lit(True).alias("_is_best"))
    kept_order = Window.partitionBy("run").orderBy(F.desc_nulls_last("_is_best"), F.desc("epoch"))
    return (
        history.join(best, ["run", "epoch"], "left")
        .withColumn("_place", F.row_number().over(kept_order))
        .where(F.col("_place") <= limit)
        .select(*history.columns)
    )
