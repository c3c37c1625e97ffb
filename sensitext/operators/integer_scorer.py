"""Linear scorers in eight bits: whole-number weights, inputs quantised as they come.

Weights are rounded once, with one scale per class head; the inputs of a row get a scale of their
own when it is scored. All products are summed as whole numbers, and the two scales and the bias
turn the sum into a logit. ``IntegerDetector`` does so for a fitted detector and knows how far a
logit can be from that of the full weights at most.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from sensitext.functions.compress import INT8_MAX, integer_dots, quantize_int8
from sensitext.operators.distill import LinearStudent
from sensitext.operators.train import Detector


def quantize_weights(heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Int8 weights and one scale per head; ties round to even and a head of zeros has scale 0."""
    heads = np.asarray(heads, float)
    scales = np.abs(heads).max(axis=1, initial=0.0) / INT8_MAX
    steps = np.divide(heads, scales[:, None], out=np.zeros_like(heads), where=scales[:, None] > 0)
    return np.rint(steps).astype(np.int8), scales


def integer_linear_scorer(
    vec_col: str, heads: Sequence[Sequence[float]]
) -> Callable[[DataFrame], DataFrame]:
    """A scorer of a vector column in the JVM: adds ``dots``, whole numbers, and ``logits``."""
    q, scales = quantize_weights(np.array(heads))
    scale_list = F.array(*[F.lit(float(s)) for s in scales])

    def add(df: DataFrame) -> DataFrame:
        rows = df.withColumn("_z", quantize_int8(vec_col))
        rows = rows.withColumn("dots", integer_dots("_z.q", q.tolist()))
        logits = F.zip_with("dots", scale_list, lambda d, s: d * F.col("_z.scale") * s)
        return rows.withColumn("logits", logits).drop("_z")

    return add


@dataclass(frozen=True)
class IntegerDetector:
    """A fitted detector with int8 weights; heads and biases as the detector has them."""

    detector: Detector
    weights: np.ndarray
    scales: np.ndarray
    bias: np.ndarray
    used: np.ndarray

    @classmethod
    def of(cls, detector: Detector) -> IntegerDetector:
        if isinstance(detector.model, LinearStudent):
            full = detector.model.weights
            heads, bias = full[:, :-1], full[:, -1]
        else:
            fitted = detector.model.stages[-1]
            heads, bias = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray()
        return cls(detector, *quantize_weights(heads), bias, heads != 0)

    @property
    def id2label(self) -> dict[int, str]:
        return self.detector.id2label

    def score(self, df: DataFrame) -> DataFrame:
        """Add ``logits`` to rows that have ``text`` or ``input_ids``."""
        rows = df if "label" not in df.columns else df.withColumnRenamed("label", "_label")
        scored = self.score_encoded(self.detector.encode(rows)).select(*rows.columns, "logits")
        return scored.withColumnRenamed("_label", "label")

    def score_encoded(self, encoded: DataFrame, detail: bool = False) -> DataFrame:
        """Add ``logits``, and with ``detail`` also ``dots`` and ``bounds``.

        ``bounds`` say how far each logit may be from that of the full weights; the only
        other difference is that of adding up doubles in another order.
        """
        cells = self._cells(encoded)
        shared = encoded.sparkSession.sparkContext.broadcast(
            (self.weights, self.scales, self.bias, self.used)
        )

        @F.arrow_udf("struct<dots:array<bigint>,logits:array<double>,bounds:array<double>>")
        def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            for at, x in batches:
                parts = _integer_scores(at, x, *shared.value)
                yield pa.StructArray.from_arrays(
                    [_rows(p) for p in parts], ["dots", "logits", "bounds"]
                )

        scored = cells.withColumn("_int8", run("_at", "_x"))
        names = ("dots", "logits", "bounds") if detail else ("logits",)
        return scored.select(*encoded.columns, *[F.col(f"_int8.{n}").alias(n) for n in names])

    def _cells(self, encoded: DataFrame) -> DataFrame:
        """Add the places ``_at`` and values ``_x`` of a row's features."""
        model = self.detector.model
        if isinstance(model, LinearStudent):
            worth = F.lit(1.0) / F.sqrt(F.size("input_ids"))
            return encoded.withColumn("_at", F.col("input_ids")).withColumn(
                "_x", F.transform("input_ids", lambda _: worth)
            )
        features = PipelineModel(model.stages[:-1]).transform(encoded)
        sparse = F.unwrap_udt("features")
        return features.select(
            *encoded.columns, sparse["indices"].alias("_at"), sparse["values"].alias("_x")
        )


def _integer_scores(
    at: pa.ListArray,
    x: pa.ListArray,
    weights: np.ndarray,
    scales: np.ndarray,
    bias: np.ndarray,
    used: np.ndarray,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Dots, logits and bounds of a batch, one row each; a single head stands for two classes."""
    place = at.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    value = x.flatten().to_numpy(zero_copy_only=False)
    sizes = at.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    if len(place) and not 0 <= place.min() <= place.max() < weights.shape[1]:
        raise ValueError(f"a feature lies outside of the scorer's {weights.shape[1]}")
    row = np.repeat(np.arange(len(sizes)), sizes)
    top = np.zeros(len(sizes))
    np.maximum.at(top, row, np.abs(value))
    step = top / INT8_MAX
    whole = np.divide(value, step[row], out=np.zeros(len(value)), where=step[row] > 0)
    whole = np.rint(whole).astype(np.int64)
    ends = np.cumsum(sizes)

    def sums(cells: np.ndarray) -> np.ndarray:
        """Sums of cells by row; no row of the batch needs to have any."""
        total = np.cumsum(np.pad(cells, ((0, 0), (1, 0))), axis=1)
        return (total[:, ends] - total[:, ends - sizes]).T

    w, met = weights[:, place].astype(np.int64), used[:, place]
    dots = sums(w * whole)
    # Half a step of either rounding, and a quarter where both meet, at weights that are not zero.
    slack = sums(met * (2 * np.abs(whole) + 1)) / 4 + sums(np.abs(w)) / 2
    size = step[:, None] * scales
    logits, bounds = dots * size + bias, slack * size
    if len(weights) == 1:
        return dots, np.hstack([-logits, logits]), np.hstack([bounds, bounds])
    return dots, logits, bounds


def _rows(values: np.ndarray) -> pa.ListArray:
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))
