"""Quality classifier: a byte-level convolutional network in NumPy.

A text is cut into blocks of ``STEP`` bytes; a filter sees two neighbouring blocks, so the
chunks overlap and cover every byte. A byte enters as a learned vector, and a block also
as the share of its bytes that equal the byte ``p`` places earlier, for each period
``p``. Filter outputs are rectified, the largest over the whole text counts, and a
logistic layer combines them.

The network is fitted on the driver with a bounded sample: at most ``max_rows`` rows of
each label (lowest hashes first), none longer than ``max_bytes``. Scoring reads all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sensitext.llm.common import byte_view, spans_of

STEP, WIDTH, FILTERS = 8, 6, 24
PERIODS = tuple(range(2, 17))
PAD = 256
GAP = 2  # blocks of padding after each text, at least the longest period
FOLDS = 5
THRESHOLD = 0.3


@dataclass
class QualityNet:
    bytes_: np.ndarray  # 257 x WIDTH
    filters: np.ndarray  # 2 x block inputs x FILTERS
    bias: np.ndarray
    weights: np.ndarray
    offset: float

    def score(self, raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        x, starts = inputs(self.bytes_, raw, bounds)[:2]
        pooled, _ = pool(self, x, starts, np.diff(bounds))
        return 1 / (1 + np.exp(-np.clip(pooled @ self.weights + self.offset, -30, 30)))


def inputs(vectors: np.ndarray, raw: np.ndarray, bounds: np.ndarray):
    """Block inputs of all texts, the first block of each, and the padded byte ids."""
    sizes = np.diff(bounds)
    blocks = np.maximum(-(-sizes // STEP), 1)
    starts = np.cumsum(np.concatenate(([GAP], blocks + GAP)))
    ids = np.full(starts[-1] * STEP, PAD, np.int16)
    ids[np.arange(len(raw)) + np.repeat(starts[:-1] * STEP - bounds[:-1], sizes)] = raw
    x = np.empty((starts[-1], STEP * WIDTH + len(PERIODS)), np.float32)
    x[:, : STEP * WIDTH] = vectors[ids].reshape(-1, STEP * WIDTH)
    text = ids != PAD
    for k, p in enumerate(PERIODS):
        same = np.zeros(len(ids), np.uint8)
        np.equal(ids[p:], ids[:-p], out=same[p:].view(bool))
        same &= text.view(np.uint8)
        # Eight flags in one word, added up by a multiplication.
        packed = (same.view(np.uint64) * np.uint64(0x0101010101010101)) >> np.uint64(56)
        x[:, STEP * WIDTH + k] = packed.astype(np.float32) / STEP
    return x, starts, ids


def pool(net: QualityNet, x: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
    """Largest output of each filter per text, and the outputs themselves."""
    y = x @ net.filters[0]
    y[:-1] += x[1:] @ net.filters[1]
    for g in range(1, GAP + 1):
        y[starts[1:] - g] = -np.inf
    y[: starts[0]] = -np.inf
    top = np.maximum.reduceat(y, starts[:-1], axis=0) if len(sizes) else y[:0]
    return np.maximum(top + net.bias, 0), y


def train(
    texts: list[bytes], labels: np.ndarray, epochs: int = 12, batch: int = 32, rate: float = 0.01,
    seed: int = 7,
) -> QualityNet:
    """Adam on the log loss; only the chunk with the largest output carries a gradient."""
    rng = np.random.default_rng(seed)
    columns = STEP * WIDTH + len(PERIODS)
    net = QualityNet(
        rng.normal(0, 0.5, (PAD + 1, WIDTH)).astype(np.float32),
        rng.normal(0, columns**-0.5, (2, columns, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32),
        rng.normal(0, FILTERS**-0.5, FILTERS).astype(np.float32),
        0.0,
    )
    net.bytes_[PAD] = 0
    values = [net.bytes_, net.filters, net.bias, net.weights, np.zeros(1, np.float32)]
    first = [np.zeros_like(v) for v in values]
    second = [np.zeros_like(v) for v in values]
    step = 0
    per_class = [np.flatnonzero(labels == c) for c in (0, 1)]
    rounds = max(1, len(texts) // batch)
    for epoch in range(epochs):
        for _ in range(rounds):
            step += 1
            pick = np.concatenate([rng.choice(c, batch // 2) for c in per_class])
            raw = np.frombuffer(b"".join(texts[i] for i in pick), np.uint8)
            bounds = np.cumsum([0, *(len(texts[i]) for i in pick)])
            x, starts, ids = inputs(net.bytes_, raw, bounds)
            pooled, y = pool(net, x, starts, np.diff(bounds))
            score = 1 / (1 + np.exp(-np.clip(pooled @ net.weights + net.offset, -30, 30)))
            err = ((score - labels[pick]) / len(pick)).astype(np.float32)
            grads = [np.zeros_like(v) for v in values]
            grads[3] = err @ pooled
            grads[4][0] = err.sum()
            back = np.outer(err, net.weights) * (pooled > 0)
            grads[2] = back.sum(0)
            for i in range(len(pick)):
                at = starts[i] + y[starts[i] : starts[i + 1] - GAP].argmax(0)
                for side in (0, 1):
                    grads[1][side] += x[at + side].T * back[i]
                    into = (net.filters[side][: STEP * WIDTH] * back[i]).T.reshape(-1, WIDTH)
                    places = ((at + side)[:, None] * STEP + np.arange(STEP)).ravel()
                    np.add.at(grads[0], ids[places], into)
            grads[0][PAD] = 0
            pace = rate * (1 - step / (rounds * epochs + 1))
            for v, g, a, b in zip(values, grads, first, second):
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                v -= pace * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-7)
            net.offset = float(values[4][0])
    return net


def constant(score: float) -> QualityNet:
    """A network that gives every text the same score."""
    columns = STEP * WIDTH + len(PERIODS)
    score = min(max(score, 1e-6), 1 - 1e-6)
    return QualityNet(
        np.zeros((PAD + 1, WIDTH), np.float32),
        np.zeros((2, columns, FILTERS), np.float32),
        np.zeros(FILTERS, np.float32),
        np.zeros(FILTERS, np.float32),
        float(np.log(score / (1 - score))),
    )


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose labels are never learnt from."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % FOLDS == 0


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    max_rows: int = 1500,
    max_bytes: int = 32768,
) -> QualityNet:
    """Learns ``label_col`` from a bounded sample of the rows that are not held out.

    An id with several labels counts with the smallest. With one label only, or none, the
    network is constant (1, 0, or 0.5).
    """
    known = (
        labels.where(F.col(label_col).isin(0, 1) & ~held_out())
        .groupBy("doc_id")
        .agg(F.min(label_col).alias("label"))
    )
    rows = docs.select("doc_id", "text").where(F.octet_length("text") <= max_bytes)
    texts: list[bytes] = []
    marks: list[int] = []
    for label in (0, 1):
        ids = known.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id")
        # A few more than needed, as some ids have no text that is short enough.
        picked = rows.join(ids.limit(2 * max_rows), "doc_id").select("doc_id", "text").distinct()
        sample = picked.orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(max_rows).collect()
        texts += [r.text.encode() for r in sample]
        marks += [label] * len(sample)
    if len(set(marks)) < 2:
        return constant(marks[0] if marks else 0.5)
    return train(texts, np.array(marks))


def score_quality(docs: DataFrame, net: QualityNet, *keep: str) -> DataFrame:
    """Columns ``keep`` and ``score`` of every row; null texts score as empty ones."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, bounds = byte_view(batch.column(batch.num_columns - 1))
            scores = [
                shared.value.score(raw[bounds[lo] : bounds[hi]], bounds[lo : hi + 1] - bounds[lo])
                for lo, hi in spans_of(bounds, 1 << 20)
            ]
            scores = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(scores, pa.float64())], [*keep, "score"]
            )

    rows = docs.select(*keep, F.col("text").alias("_text"))
    schema = rows.schema.fields[:-1]
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return rows.mapInArrow(run, f"{types}, score double")
