"""Distillation of a teacher into a linear student over token ids.

The student's features are the token ids of a text themselves, each worth one over the
square root of the text's length, with one weight per id and class. Training is local
mini-batch descent: in every epoch each worker, a fixed share of the rows, goes through its rows in
an order of hashes, a small batch at a time, and makes an AdamW step after each; it touches
the weights of the batch's ids alone. A grouped sum then averages the workers' weights and moments by
feature, over the workers that touched it, and the driver, which holds nothing but these, sends
them out for the next epoch. Rows are streamed, so a worker holds one batch at a time.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sensitext.constants import (
    DISTILL_BATCH,
    KD_WEIGHT,
    SEED,
    STUDENT_EPOCHS,
    STUDENT_LR,
    TEACHER_WEIGHT_DECAY,
    TEMPERATURE,
    VOCAB_SIZE,
)
from sensitext.functions.losses import logit_gradient
from sensitext.functions.scoring import softmax_t
from sensitext.operators.predict import score
from sensitext.session import materialise, stored_once
from sensitext.sources.sinks import append_history

# AdamW constants as published.
BETA1, BETA2, EPSILON = 0.9, 0.999, 1e-8
# Copies of a row that are dealt out together.
_COPIES = 1000


def soft_labels(
    df: DataFrame,
    teacher,
    temperature: float = TEMPERATURE,
    keep: Sequence[str] | None = None,
    store: bool = True,
) -> DataFrame:
    """Teacher logits and softened probabilities of each row, written once and read back.

    A frozen teacher gives the same answer in every epoch, so it scores each row once.
    """
    keep = list(df.columns) if keep is None else list(keep)
    scored = score(df, teacher, "t_logits").select(*keep, "t_logits")
    soft = scored.withColumn("t_soft", softmax_t("t_logits", temperature))
    return materialise(soft, "soft-labels") if store else soft


def kd_gradient(
    df: DataFrame,
    vec_col: str,
    s_logits: str = "s_logits",
    t_logits: str = "t_logits",
    label: str = "label",
    temperature: float = TEMPERATURE,
    kd_weight: float = KD_WEIGHT,
    groups: int = 64,
) -> DataFrame:
    """Gradient of the mean loss by a linear head's weights: ``class, feature, grad``.

    The outer product of logit gradient and features is summed as a vector in the JVM, by
    ``groups`` of tasks; their sums are then merged weight by weight, so no task takes the
    vectors of all others.
    """
    gradient = logit_gradient(s_logits, t_logits, label, temperature, kd_weight)
    rows = df.select(
        F.col(vec_col).cast("array<double>").alias("_v"),
        gradient.alias("_g"),
        (F.spark_partition_id() % groups).alias("_group"),
    )
    outer = F.flatten(F.transform("_g", lambda g: F.transform("_v", lambda x: g * x)))
    sums = rows.groupBy("_group").agg(
        Summarizer.sum(array_to_vector(outer)).alias("s"),
        F.count(F.lit(1)).alias("n"),
        F.max(F.size("_v")).alias("width"),
    )
    cells = sums.select("n", "width", F.posexplode(vector_to_array("s")).alias("at", "x"))
    return cells.groupBy(
        F.floor(F.col("at") / F.col("width")).cast("int").alias("class"),
        (F.col("at") % F.col("width")).cast("int").alias("feature"),
    ).agg((F.sum("x") / F.sum("n")).alias("grad"))


@dataclass
class LinearStudent:
    """Weights per class and token id, and a bias per class in the last column."""

    weights: np.ndarray
    spec: dict = field(default_factory=dict)

    def score_encoded(self, encoded: DataFrame, out: str = "logits") -> DataFrame:
        """Add logits to rows with unpadded ``input_ids``."""
        shared = encoded.sparkSession.sparkContext.broadcast(self.weights)

        @F.arrow_udf("array<double>")
        def to_logits(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for batch in batches:
                logits, _, _ = _forward(shared.value, batch)
                offsets = np.arange(len(batch) + 1, dtype=np.int32) * logits.shape[1]
                yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(logits.ravel()))

        return encoded.withColumn(out, to_logits("input_ids"))

    def save(self, spark: SparkSession, path: str) -> None:
        """Weights as a table of ``feature, w`` and the settings as JSON."""
        rows = [(i, [float(x) for x in column]) for i, column in enumerate(self.weights.T)]
        spark.createDataFrame(rows, "feature int, w array<double>").write.mode(
            "overwrite"
        ).parquet(os.path.join(path, "weights"))
        settings = spark.createDataFrame([(json.dumps(self.spec),)], "value string")
        settings.coalesce(1).write.mode("overwrite").text(os.path.join(path, "settings"))

    @staticmethod
    def load(spark: SparkSession, path: str) -> LinearStudent:
        rows = spark.read.parquet(os.path.join(path, "weights")).orderBy("feature").collect()
        spec = json.loads(spark.read.text(os.path.join(path, "settings")).first().value)
        return LinearStudent(np.array([r.w for r in rows]).T, spec)


def fit_student(
    rows: DataFrame,
    n_features: int = VOCAB_SIZE,
    epochs: int = STUDENT_EPOCHS,
    lr: float = STUDENT_LR,
    weight_decay: float = TEACHER_WEIGHT_DECAY,
    temperature: float = TEMPERATURE,
    kd_weight: float = KD_WEIGHT,
    history_path: str | None = None,
    run: str = "student",
    batch_size: int = DISTILL_BATCH,
    workers: int | None = None,
    seed: int = SEED,
    min_rows: int = 1,
    balanced: bool = False,
    sparsity: float = 0.0,
) -> tuple[LinearStudent, list[tuple]]:
    """Distil over ``input_ids, label, t_logits, split``; returns the best student and history.

    ``workers`` shares of the training rows, as many as shuffle partitions unless given, make AdamW
    steps over batches of ``batch_size`` rows and are averaged after each epoch; the rate falls
    evenly from ``lr`` to zero over the epochs. The result depends on the rows, ``workers`` and
    ``seed``, not on how the rows are stored. A row's share and place come from hashes of its
    content and the number of the copy, so no text, however frequent, fills a share. After each
    epoch the validation rows are scored; the weights with the highest accuracy are kept and the
    latest wins a tie. The training loss of an epoch is the mean over its batches. An id outside of
    ``0 .. n_features - 1`` is an error.

    Ids in fewer than ``min_rows`` training rows learn nothing. With ``balanced`` both classes weigh
    the same in the cross-entropy. With ``sparsity`` every step moves the weights it touches towards
    zero by that share of the rate, and no further, which keeps ids at zero that matter little.
    """
    spark = rows.sparkSession
    workers = workers or int(spark.conf.get("spark.sql.shuffle.partitions"))
    narrow = rows.select(
        "input_ids", F.col("label").cast("int").alias("label"), "t_logits", "split"
    )
    state = _State.empty(n_features)
    best, best_accuracy, history = state.weights, 0.0, []
    with stored_once(_shares(narrow, workers, seed), "student-input") as stored:
        train = stored.where("split = 'train'")
        validation = stored.where("NOT split <=> 'train'")
        rates, class_weights = _weights_of(train, n_features, min_rows, balanced)
        for epoch in range(1, epochs + 1):
            rate = lr * (1 - (epoch - 1) / epochs)
            update = _Update(rate * rates, weight_decay, temperature, kd_weight, batch_size, class_weights, sparsity)
            state, train_loss = _epoch(train, state, update, F.xxhash64("key", F.lit(seed), F.lit(epoch)))
            figures = _pass(validation, state.weights, n_features, temperature, kd_weight, False)
            accuracy = figures["val_acc"]
            history.append((run, epoch, state.steps, train_loss, figures["eval_loss"], accuracy))
            if accuracy is not None and accuracy >= best_accuracy:
                best, best_accuracy = state.weights, accuracy
    if history_path is not None:
        append_history(spark, history, history_path)
    if all(h[5] is None for h in history):
        best = state.weights
    return LinearStudent(best, {"n_features": n_features, "num_labels": 2}), history


def _shares(rows: DataFrame, workers: int, seed: int) -> DataFrame:
    """``rows`` with ``key``, a hash of content and number of copy, and ``worker``.

    Copies are counted first and dealt out in runs of ``_COPIES``, so those of a hot text are
    never in one task.
    """
    content = rows.columns
    counted = rows.groupBy(*content).agg(F.count(F.lit(1)).alias("_n"))
    last = F.floor((F.col("_n") - 1) / _COPIES)
    parts = counted.select(*content, "_n", F.explode(F.sequence(F.lit(0), last)).alias("_part"))
    first = F.col("_part") * _COPIES
    copies = F.sequence(first, F.least(F.col("_n"), first + _COPIES) - 1)
    dealt = parts.repartition(F.xxhash64(*content, "_part")).select(
        *content, F.explode(copies).alias("_copy")
    )
    keyed = dealt.withColumn("key", F.xxhash64(*content, "_copy")).drop("_copy")
    return keyed.withColumn("worker", F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(workers)).cast("int"))


def _weights_of(
    train: DataFrame, n_features: int, min_rows: int, balanced: bool
) -> tuple[np.ndarray, np.ndarray]:
    """Rate of every id, one for the bias, and the weight of every class."""
    ids = train.select(F.explode(F.array_distinct("input_ids")).alias("id"))
    counts = ids.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    found = counts.where(F.col("id").between(0, n_features - 1)).toPandas()
    sizes = {r.label: r.n for r in train.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(sizes.values())
    rates = np.zeros(n_features + 1)
    seen = found["n"].to_numpy()
    rates[found["id"].to_numpy()] = seen >= min_rows
    rates[-1] = 1.0
    weights = np.ones(2)
    if balanced:
        for label, n in sizes.items():
            weights[label] = total / (len(sizes) * n)
    return rates, weights


@dataclass
class _State:
    """Weights and moments, bias last, and the steps made so far."""

    weights: np.ndarray
    first: np.ndarray
    second: np.ndarray
    steps: int = 0

    @staticmethod
    def empty(n_features: int) -> _State:
        return _State(*(np.zeros((2, n_features + 1)) for _ in range(3)))

    def copy(self) -> _State:
        return _State(self.weights.copy(), self.first.copy(), self.second.copy(), self.steps)


@dataclass(frozen=True)
class _Update:
    """Settings of the steps of one epoch."""

    rates: np.ndarray
    weight_decay: float
    temperature: float
    kd_weight: float
    batch_size: int
    class_weights: np.ndarray
    sparsity: float

    def step(
        self, state: _State, ids: pa.ListArray, label: np.ndarray, teacher: np.ndarray, rows: np.ndarray
    ) -> float:
        """One AdamW step on a batch; returns its mean loss and counts its rows by feature."""
        logits, flat, sizes = _forward(state.weights, ids)
        loss, _, slope = _losses(
            logits, label, teacher, self.temperature, self.kd_weight, self.class_weights[label]
        )
        slope /= len(label)
        used, place = np.unique(flat, return_inverse=True)
        used = np.append(used, state.weights.shape[1] - 1)
        per_id = np.repeat(slope / np.sqrt(sizes)[:, None], sizes, axis=0)
        gradient = np.empty((2, len(used)))
        for c in range(2):
            gradient[c, :-1] = np.bincount(place, per_id[:, c], minlength=len(used) - 1)
        gradient[:, -1] = slope.sum(axis=0)
        state.steps += 1
        first = state.first[:, used] = BETA1 * state.first[:, used] + (1 - BETA1) * gradient
        second = state.second[:, used] = BETA2 * state.second[:, used] + (1 - BETA2) * gradient**2
        move = (first / (1 - BETA1**state.steps)) / (
            np.sqrt(second / (1 - BETA2**state.steps)) + EPSILON
        )
        rate = self.rates[used]
        state.weights[:, used] *= 1 - rate * self.weight_decay
        state.weights[:, used] -= rate * move
        if self.sparsity:
            ids = used[:-1]
            least = self.sparsity * rate[:-1]
            state.weights[:, ids] = np.sign(state.weights[:, ids]) * np.maximum(
                np.abs(state.weights[:, ids]) - least, 0.0
            )
        rows[used[:-1]] += np.bincount(place, minlength=len(used) - 1)
        rows[-1] += len(label)
        return float(loss.mean())


def _epoch(train: DataFrame, state: _State, update: _Update, order: Column) -> tuple[_State, float]:
    """One epoch of all workers, averaged, and the mean loss of its batches.

    Each worker sends the features it touched, so the result has at most one row a feature.
    """
    width = state.weights.shape[1]
    shared = train.sparkSession.sparkContext.broadcast(state)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for worker in _by_worker(batches, update.batch_size):
            own, rows, losses = shared.value.copy(), np.zeros(width), []
            for batch in worker:
                label = batch.column("label").to_numpy(zero_copy_only=False).astype(int)
                teacher = batch.column("t_logits").flatten().to_numpy().reshape(len(label), -1)
                losses.append(update.step(own, batch.column("input_ids"), label, teacher, rows))
            used = np.flatnonzero(rows)
            cells = np.concatenate([x[:, used] * rows[used] for x in (own.weights, own.first, own.second)])
            # The last row holds losses, batches and the steps so far.
            end = np.array([sum(losses), len(losses), own.steps, 1.0, 0.0, 0.0])
            values = np.concatenate([cells, end[:, None]], axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.append(used, width).astype(np.int32)),
                    pa.array(np.append(rows[used], 0.0)),
                    *map(pa.array, values),
                ],
                names=["at", "rows", *(f"x{i}" for i in range(6))],
            )

    columns = [f"x{i}" for i in range(6)]
    dealt = train.withColumn("_order", order).repartition("worker")
    parts = (
        dealt.sortWithinPartitions("worker", "_order", "key")
        .select("input_ids", "label", "t_logits", "worker")
        .mapInArrow(work, "at int, rows double, " + ", ".join(f"{c} double" for c in columns))
    )
    sums = [F.sum(c).alias(c) for c in ("rows", *columns)]
    merged = parts.groupBy("at").agg(*sums).toPandas()
    shared.destroy()
    end = merged[merged["at"] == width]
    if end.empty:
        raise ValueError("no training rows")
    cells = merged[merged["at"] < width]
    at = cells["at"].to_numpy()
    mean = cells[columns].to_numpy().T / cells["rows"].to_numpy()
    after = state.copy()
    for k, x in enumerate((after.weights, after.first, after.second)):
        x[:, at] = mean[2 * k : 2 * k + 2]
    loss, batches, steps, workers = (float(end[c].iloc[0]) for c in columns[:4])
    after.steps = round(steps / workers)
    return after, loss / batches


def _by_worker(
    batches: Iterator[pa.RecordBatch], size: int
) -> Iterator[Iterator[pa.Table]]:
    """For each worker of a task its rows, in batches of ``size``; the last may be short."""
    rest: pa.Table | None = None
    stream = (pa.Table.from_batches([b]) for b in batches if b.num_rows)

    def more() -> bool:
        nonlocal rest
        table = next(stream, None)
        if table is not None:
            rest = table if rest is None else pa.concat_tables([rest, table])
        return table is not None

    def of_worker(worker: int) -> Iterator[pa.RecordBatch]:
        nonlocal rest
        while rest is not None:
            own = int((np.asarray(rest.column("worker")) == worker).sum())
            if own == rest.num_rows and own < size and more():
                continue
            if not own:
                return
            for batch in rest.slice(0, min(own, size)).combine_chunks().to_batches():
                yield batch
            rest = rest.slice(min(own, size))
            if not rest.num_rows:
                rest = None
                more()

    while rest is not None or more():
        yield of_worker(rest.column("worker")[0].as_py())


def _losses(
    logits: np.ndarray,
    label: np.ndarray,
    teacher: np.ndarray,
    temperature: float,
    kd_weight: float,
    row_weight: np.ndarray | float = 1.0,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Loss of each row, its cross-entropy alone, and the slope of the loss by the logits.

    ``row_weight`` weighs the cross-entropy within the loss.
    """
    log_p = _log_softmax(logits)
    at_label = np.arange(len(label)), label
    ce = -log_p[at_label]
    log_s = _log_softmax(logits / temperature)
    log_t = _log_softmax(teacher / temperature)
    p_t = np.exp(log_t)
    kd = temperature**2 * (p_t * (log_t - log_s)).sum(axis=1)
    slope = np.exp(log_p)
    slope[at_label] -= 1.0
    slope *= np.reshape(row_weight, (-1, 1))
    slope += kd_weight * temperature * (np.exp(log_s) - p_t)
    return row_weight * ce + kd_weight * kd, ce, slope


def _pass(
    stored: DataFrame,
    weights: np.ndarray,
    n_features: int,
    temperature: float,
    kd_weight: float,
    need_train: bool = True,
) -> dict:
    """Loss, gradient and validation figures of one set of weights, in one job.

    The result has at most ``n_features + 3`` rows.
    """
    shared = stored.sparkSession.sparkContext.broadcast(weights)
    train_row, val_row, loss_row = n_features + 1, n_features + 2, n_features + 3

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        gradient = np.zeros_like(w)
        sums = {train_row: np.zeros(2), val_row: np.zeros(2), loss_row: np.zeros(2)}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            ids = batch.column("input_ids")
            label = batch.column("label").to_numpy(zero_copy_only=False).astype(int)
            teacher = batch.column("t_logits").flatten().to_numpy().reshape(len(label), -1)
            train = np.array(batch.column("split").to_pylist()) == "train"
            logits, flat, sizes = _forward(w, ids)
            loss, ce, slope = _losses(logits, label, teacher, temperature, kd_weight)
            sums[train_row] += (loss[train].sum(), train.sum())
            correct = logits.argmax(axis=1) == label
            sums[val_row] += (correct[~train].sum(), (~train).sum())
            sums[loss_row] += (ce[~train].sum(), 0.0)

            slope[~train] = 0.0
            per_id = np.repeat(slope / np.sqrt(sizes)[:, None], sizes, axis=0)
            for c in range(len(w)):
                gradient[c, :-1] += np.bincount(flat, per_id[:, c], minlength=n_features)
                gradient[c, -1] += slope[:, c].sum()
        used = np.flatnonzero(gradient.any(axis=0))
        at = np.concatenate([used, list(sums)]).astype(np.int32)
        cells = np.concatenate([gradient[:, used], np.array(list(sums.values())).T], axis=1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(cells[0]), pa.array(cells[1])], names=["at", "v0", "v1"]
        )

    parts = stored.mapInArrow(partial, "at int, v0 double, v1 double")
    merged = parts.groupBy("at").agg(F.sum("v0").alias("v0"), F.sum("v1").alias("v1")).toPandas()
    shared.destroy()
    at = merged["at"].to_numpy()
    values = merged[["v0", "v1"]].to_numpy().T
    full = np.zeros((2, n_features + 4))
    full[:, at] = values
    loss, n_train = full[:, train_row]
    correct, n_val = full[:, val_row]
    if n_train == 0 and need_train:
        raise ValueError("no training rows")
    return {
        "gradient": full[:, : n_features + 1] / max(n_train, 1),
        "train_loss": float(loss / n_train) if n_train else None,
        "eval_loss": float(full[0, loss_row] / n_val) if n_val else None,
        "val_acc": float(correct / n_val) if n_val else None,
    }


def _forward(weights: np.ndarray, ids: pa.ListArray):
    """Logits of each id list, with the flat ids and list sizes; lists are never empty."""
    flat = ids.flatten().to_numpy(zero_copy_only=False)
    sizes = ids.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    features = weights.shape[1] - 1
    if len(flat) and not 0 <= flat.min() <= flat.max() < features:
        raise ValueError(f"an id lies outside of the student's {features} features")
    if len(sizes) == 0:
        return np.zeros((0, len(weights))), flat, sizes
    starts = np.cumsum(sizes) - sizes
    sums = np.add.reduceat(weights[:, flat], starts, axis=1)
    return (sums / np.sqrt(sizes) + weights[:, -1:]).T, flat, sizes


def _log_softmax(z: np.ndarray) -> np.ndarray:
    shifted = z - z.max(axis=1, keepdims=True)
    return shifted - np.log(np.exp(shifted).sum(axis=1, keepdims=True))
