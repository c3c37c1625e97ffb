"""Queries over metrics, training history and distillation losses."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from sensitext.constants import DISTILL_BATCH, LOG_EVERY
from sensitext.functions.losses import ce_loss, hidden_loss, kd_loss, total_loss
from sensitext.functions.scoring import argmax
from sensitext.operators import history as hist
from sensitext.operators import metrics
from sensitext.operators.distill import kd_gradient, soft_labels
from sensitext.operators.predict import linear_scorer
from sensitext.operators.prep import assign_batches
from sensitext.plans.inputs import (
    SQL_HISTORY,
    SQL_SCORED,
    SQL_TRACE,
    TEACHER_HEADS,
    history,
    moved_logits,
    r6,
    scored,
    sql_ce,
    sql_kd,
    sql_pred,
    sql_r6,
    sql_softmax,
    trace,
    trace_loss,
    vectors,
)

_SMALL_BATCH = 4


def _predicted(spark, data_dir):
    return scored(spark, data_dir).select("split", "label", argmax("t_logits").alias("pred"))


def confusion(spark, data_dir):
    return metrics.confusion(_predicted(spark, data_dir), "split")


def accuracy(spark, data_dir):
    return metrics.accuracy(_predicted(spark, data_dir), "split").withColumn(
        "accuracy", r6("accuracy")
    )


def precision_recall_f1(spark, data_dir):
    rows = metrics.precision_recall_f1(_predicted(spark, data_dir), "split")
    return rows.withColumns({c: r6(c) for c in ("precision", "recall", "f1")})


def compute_metrics(spark, data_dir):
    return metrics.compute_metrics(_predicted(spark, data_dir), "split")


def eval_loss(spark, data_dir):
    rows = metrics.eval_loss(scored(spark, data_dir), "split", "t_logits")
    return rows.withColumn("eval_loss", r6("eval_loss"))


def _batched(spark, data_dir, batch_size, epochs):
    """Batches of the training rows, as a loader of the training split gives them."""
    train = scored(spark, data_dir).where(F.col("split") == "train")
    rows = train.select("vec_id", "label", "t_logits", "s_logits")
    return assign_batches(rows, batch_size, "vec_id", epochs=epochs).withColumn(
        "logits", moved_logits()
    )


def epoch_loss(spark, data_dir):
    rows = _batched(spark, data_dir, DISTILL_BATCH, [1, 2, 3]).withColumn("loss", trace_loss())
    return metrics.epoch_loss(rows).withColumn("train_loss", r6("train_loss"))


def val_accuracy(spark, data_dir):
    rows = trace(spark, data_dir).where(F.col("split") == "validation")
    return metrics.val_accuracy_by_epoch(rows).withColumn("val_acc", r6("val_acc"))


def log_rollup(spark, data_dir):
    batches = _batched(spark, data_dir, _SMALL_BATCH, [1, 2]).withColumn("loss", trace_loss())
    steps = batches.groupBy("epoch", "batch_id").agg(F.avg("loss").alias("train_loss"))
    log = steps.select(
        F.concat(F.lit("e"), F.col("epoch").cast("string")).alias("run"),
        (F.col("batch_id") + 1).cast("int").alias("step"),
        "train_loss",
    )
    return metrics.log_rollup(log).withColumn("train_loss", r6("train_loss"))


def compare_models(spark, data_dir):
    rows = metrics.compare_models(scored(spark, data_dir))
    return rows.withColumns(
        {c: r6(c) for c in ("teacher_accuracy", "student_accuracy", "drop")}
    )


def best_by_loss(spark, data_dir):
    return hist.best_by_loss(history(spark, data_dir))


def best_by_accuracy(spark, data_dir):
    return hist.best_by_accuracy(history(spark, data_dir)).withColumn("val_acc", r6("val_acc"))


def is_new_best(spark, data_dir):
    return hist.is_new_best(history(spark, data_dir)).select("run", "epoch", "is_new_best")


def retained(spark, data_dir):
    return hist.retained(history(spark, data_dir)).select("run", "epoch", "step", "eval_loss")


def soft_labels_query(spark, data_dir):
    soft = soft_labels(
        vectors(spark, data_dir), linear_scorer("embedding", TEACHER_HEADS), keep=("vec_id",)
    )
    return soft.select(
        "vec_id",
        r6(F.element_at("t_logits", 1)).alias("t_logit0"),
        r6(F.element_at("t_logits", 2)).alias("t_logit1"),
        r6(F.element_at("t_soft", 1)).alias("t_soft0"),
        r6(F.element_at("t_soft", 2)).alias("t_soft1"),
    )


def kd_loss_query(spark, data_dir):
    return scored(spark, data_dir).select(
        "vec_id", r6(kd_loss("s_logits", "t_logits")).alias("kd")
    )


def ce_loss_query(spark, data_dir):
    return scored(spark, data_dir).select("vec_id", r6(ce_loss("s_logits", "label")).alias("ce"))


def _layers(count: int, stride: int, factor: float) -> Column:
    """``count`` layers of eight values each, taken from the embedding."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(count - 1)),
        lambda i: F.transform(
            F.slice("embedding", i * stride + 1, 8), lambda x: x * F.lit(factor)
        ),
    )


def hidden_loss_query(spark, data_dir):
    rows = vectors(spark, data_dir).select(
        "vec_id",
        _layers(4, 16, 0.5).alias("s_layers"),
        _layers(8, 8, 1.0).alias("t_layers"),
        _layers(4, 8, 1.0).alias("t_short"),
    )
    return rows.select(
        "vec_id",
        r6(hidden_loss("s_layers", "t_layers")).alias("hidden"),
        r6(hidden_loss("s_layers", "t_short")).alias("hidden_equal_depth"),
    )


def total_loss_query(spark, data_dir):
    train = scored(spark, data_dir).where(F.col("split") == "train")
    rows = train.select(
        "vec_id",
        ce_loss("s_logits", "label").alias("ce"),
        kd_loss("s_logits", "t_logits").alias("kd"),
        hidden_loss(_layers(4, 16, 0.5), _layers(8, 8, 1.0)).alias("hidden"),
    )
    batches = (
        assign_batches(rows, DISTILL_BATCH, "vec_id")
        .groupBy("epoch", "batch_id")
        .agg(F.avg("ce").alias("ce"), F.avg("kd").alias("kd"), F.avg("hidden").alias("hidden"))
    )
    total = total_loss(F.col("ce"), F.col("kd"), F.col("hidden"))
    return batches.withColumn("total", total).withColumns(
        {c: r6(c) for c in ("ce", "kd", "hidden", "total")}
    )


def kd_gradient_query(spark, data_dir):
    train = scored(spark, data_dir).where(F.col("split") == "train")
    return kd_gradient(train, "embedding").withColumn("grad", r6("grad"))


QUERIES = {
    "confusion": confusion,
    "accuracy": accuracy,
    "precision_recall_f1": precision_recall_f1,
    "compute_metrics": compute_metrics,
    "eval_loss": eval_loss,
    "epoch_loss": epoch_loss,
    "val_accuracy": val_accuracy,
    "log_rollup": log_rollup,
    "compare_models": compare_models,
    "best_by_loss": best_by_loss,
    "best_by_accuracy": best_by_accuracy,
    "is_new_best": is_new_best,
    "retained": retained,
    "soft_labels": soft_labels_query,
    "kd_loss": kd_loss_query,
    "ce_loss": ce_loss_query,
    "hidden_loss": hidden_loss_query,
    "total_loss": total_loss_query,
    "kd_gradient": kd_gradient_query,
}

_T_PRED, _S_PRED = sql_pred("t0", "t1"), sql_pred("s0", "s1")
_S_CE, _S_KD = sql_ce("s0", "s1"), sql_kd("s0", "s1")
_SOFT = sql_softmax("t0", "t1", 4.0)
_WITH_PRED = f"""WITH {SQL_SCORED}, p AS (SELECT split, label, {_T_PRED} AS pred FROM scored),
    c AS (SELECT split, count(*) FILTER (label = 1 AND pred = 1) AS tp,
        count(*) FILTER (label = 0 AND pred = 1) AS fp,
        count(*) FILTER (label = 1 AND pred = 0) AS fn,
        count(*) FILTER (label = 0 AND pred = 0) AS tn,
        avg((label = pred)::INT) AS acc FROM p GROUP BY split)"""
_PRECISION = "coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0)"
_RECALL = "coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0)"
_F1 = "coalesce(2 * tp::DOUBLE / nullif(2 * tp + fp + fn, 0), 0)"


def _round4(x: str) -> str:
    return f"round_even(({x}) * 10000, 0) / 10000"


def _sql_batches(batch_size: int, source: str = "trace") -> str:
    return f"""batched AS (SELECT *, (row_number() OVER (PARTITION BY epoch
        ORDER BY md5(vec_id || ':42:' || epoch), vec_id) - 1) // {batch_size} AS batch_id
      FROM {source} WHERE split = 'train')"""


def _sql_hidden(teacher_stride: int) -> str:
    layers = [
        "list_avg(list_transform(range(8), lambda k: "
        f"pow(v[({i * 16} + k + 1)] * 0.5 - v[({i * teacher_stride} + k + 1)], 2)))"
        for i in range(4)
    ]
    return "(" + " + ".join(layers) + ")"


def _sql_gradient(j: int) -> str:
    p, s = sql_softmax("s0", "s1")[j], sql_softmax("s0", "s1", 4.0)[j]
    return f"({p} - (label = {j})::INT + 4 * ({s} - {_SOFT[j]}))"


ORACLE = {
    "confusion": f"{_WITH_PRED} SELECT split, tp, fp, fn, tn FROM c",
    "accuracy": f"{_WITH_PRED} SELECT split, {sql_r6('acc')} AS accuracy FROM c",
    "precision_recall_f1": f"""{_WITH_PRED} SELECT split, {sql_r6(_PRECISION)} AS precision,
        {sql_r6(_RECALL)} AS recall, {sql_r6(_F1)} AS f1 FROM c""",
    "compute_metrics": f"""{_WITH_PRED} SELECT split, {_round4('acc')} AS eval_accuracy,
        {_round4(_PRECISION)} AS eval_precision, {_round4(_RECALL)} AS eval_recall,
        {_round4(_F1)} AS eval_f1 FROM c""",
    "eval_loss": f"""WITH {SQL_SCORED} SELECT split,
        {sql_r6(f"avg({sql_ce('t0', 't1')})")} AS eval_loss FROM scored GROUP BY split""",
    "epoch_loss": f"""WITH {SQL_TRACE}, {_sql_batches(DISTILL_BATCH)}
        SELECT epoch, {sql_r6('avg(b)')} AS train_loss FROM (
          SELECT epoch, batch_id, avg(loss) AS b FROM batched WHERE epoch <= 3
          GROUP BY epoch, batch_id) GROUP BY epoch""",
    "val_accuracy": f"""WITH {SQL_TRACE} SELECT epoch, sum((pred = label)::INT)::BIGINT AS correct,
        count(*) AS total, {sql_r6('avg((pred = label)::INT)')} AS val_acc
        FROM trace WHERE split = 'validation' GROUP BY epoch""",
    "log_rollup": f"""WITH {SQL_TRACE}, {_sql_batches(_SMALL_BATCH)},
        steps AS (SELECT 'e' || epoch AS run, (batch_id + 1)::INT AS step, avg(loss) AS loss
          FROM batched WHERE epoch <= 2 GROUP BY epoch, batch_id)
        SELECT run, ((step - 1) // {LOG_EVERY})::INT AS log_row, max(step) AS step,
          {sql_r6('avg(loss)')} AS train_loss FROM steps GROUP BY 1, 2""",
    "compare_models": f"""WITH {SQL_SCORED},
        m AS (SELECT split, avg(({_T_PRED} = label)::INT) AS t, avg(({_S_PRED} = label)::INT) AS s
          FROM scored GROUP BY split)
        SELECT split, {sql_r6('t')} AS teacher_accuracy, {sql_r6('s')} AS student_accuracy,
          {sql_r6('t - s')} AS "drop" FROM m""",
    "best_by_loss": f"""WITH {SQL_HISTORY} SELECT run, epoch, eval_loss FROM history
        QUALIFY row_number() OVER (PARTITION BY run ORDER BY eval_loss, epoch) = 1""",
    "best_by_accuracy": f"""WITH {SQL_HISTORY}
        SELECT run, epoch, {sql_r6('val_acc')} AS val_acc FROM history
        QUALIFY row_number() OVER (PARTITION BY run ORDER BY val_acc DESC, epoch DESC) = 1""",
    "is_new_best": f"""WITH {SQL_HISTORY} SELECT run, epoch, val_acc >= coalesce(max(val_acc) OVER (
          PARTITION BY run ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
          AS is_new_best FROM history""",
    "retained": f"""WITH {SQL_HISTORY},
        b AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY eval_loss, epoch) = 1 AS best
          FROM history)
        SELECT run, epoch, step, eval_loss FROM b
        QUALIFY row_number() OVER (PARTITION BY run ORDER BY best DESC, epoch DESC) <= 2""",
    "soft_labels": f"""WITH {SQL_SCORED} SELECT vec_id, {sql_r6('t0')} AS t_logit0,
        {sql_r6('t1')} AS t_logit1, {sql_r6(_SOFT[0])} AS t_soft0,
        {sql_r6(_SOFT[1])} AS t_soft1 FROM scored""",
    "kd_loss": f"WITH {SQL_SCORED} SELECT vec_id, {sql_r6(_S_KD)} AS kd FROM scored",
    "ce_loss": f"WITH {SQL_SCORED} SELECT vec_id, {sql_r6(_S_CE)} AS ce FROM scored",
    "hidden_loss": f"""WITH {SQL_SCORED} SELECT vec_id, {sql_r6(_sql_hidden(16))} AS hidden,
        {sql_r6(_sql_hidden(8))} AS hidden_equal_depth FROM scored""",
    "total_loss": f"""WITH {SQL_SCORED},
        one AS (SELECT vec_id, split, 1::INT AS epoch, {_S_CE} AS ce, {_S_KD} AS kd,
          {_sql_hidden(16)} AS hidden FROM scored),
        {_sql_batches(DISTILL_BATCH, 'one')},
        means AS (SELECT epoch, batch_id, avg(ce) AS ce, avg(kd) AS kd, avg(hidden) AS hidden
          FROM batched GROUP BY epoch, batch_id)
        SELECT epoch, batch_id, {sql_r6('ce')} AS ce, {sql_r6('kd')} AS kd,
          {sql_r6('hidden')} AS hidden, {sql_r6('ce + kd + 0.5 * hidden')} AS total FROM means""",
    "kd_gradient": f"""WITH {SQL_SCORED},
        g AS (SELECT 0 AS class, v, {_sql_gradient(0)} AS g FROM scored
            WHERE split = 'train'
          UNION ALL SELECT 1, v, {_sql_gradient(1)} FROM scored WHERE split = 'train'),
        cells AS (SELECT class, g, (generate_subscripts(v, 1) - 1)::INT AS feature, unnest(v) AS x
          FROM g)
        SELECT class, feature, {sql_r6('avg(g * x)')} AS grad FROM cells GROUP BY class, feature""",
}
