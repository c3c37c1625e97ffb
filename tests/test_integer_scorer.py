"""Scorers in eight bits equal whole-number sums made by hand and keep within their bounds."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensitext.functions.compress import INT8_MAX
from sensitext.operators.distill import LinearStudent
from sensitext.operators.integer_scorer import (
    IntegerDetector,
    integer_linear_scorer,
    quantize_weights,
)
from sensitext.operators.parity import parity_report, parity_summary
from sensitext.operators.train import Detector, fit_teacher
from sensitext.plans.inputs import labelled
from sensitext.plans.trained_checks import int8_checks


def by_hand(at, x, heads, bias):
    """Dots and logits of one row, cell by cell."""
    top = max((abs(v) for v in x), default=0.0) / INT8_MAX
    dots, logits = [], []
    for head, b in zip(heads, bias):
        scale = max(abs(w) for w in head) / INT8_MAX
        dot = 0
        for i, v in zip(at, x):
            qx = round(v / top) if top else 0
            dot += qx * (round(head[i] / scale) if scale else 0)
        dots.append(dot)
        logits.append(dot * top * scale + b)
    return dots, logits


def test_weights_round_half_to_even_and_zeros_stay():
    q, scales = quantize_weights([[127.0, 0.5, 1.5, -2.5], [0.0, 0.0, 0.0, 0.0]])
    assert q.tolist() == [[127, 0, 2, -2], [0, 0, 0, 0]] and scales.tolist() == [1.0, 0.0]


def test_dense_scorer(spark):
    vectors = [[0.5, -1.0, 0.25], [0.0, 0.0, 0.0], [1e-3, 2e-3, -3e-3]]
    heads = [[1.0, -0.5, 0.3], [0.0, 2.0, 1.0]]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "id int, v array<double>")
    got = {r.id: r for r in integer_linear_scorer("v", heads)(df).collect()}
    for i, v in enumerate(vectors):
        dots, logits = by_hand(range(3), v, heads, [0.0, 0.0])
        assert got[i].dots == dots and got[i].logits == pytest.approx(logits)


def test_student_in_int8(spark):
    rng = np.random.default_rng(3)
    weights = rng.normal(size=(2, 41))
    weights[:, :-1][rng.random((2, 40)) < 0.3] = 0.0
    ids = [rng.integers(0, 40, n).tolist() for n in (1, 2, 17, 200)]
    detector = Detector(LinearStudent(weights), {})
    df = spark.createDataFrame([(i, x) for i, x in enumerate(ids)], "id int, input_ids array<int>")
    full = detector.score_encoded(df).withColumnRenamed("logits", "full")
    rows = IntegerDetector.of(detector).score_encoded(full, detail=True)
    for r in rows.collect():
        x = [1 / np.sqrt(len(ids[r.id]))] * len(ids[r.id])
        dots, logits = by_hand(ids[r.id], x, weights[:, :-1], weights[:, -1])
        assert r.dots == dots and r.logits == pytest.approx(logits)
        assert all(abs(a - b) <= c + 1e-12 for a, b, c in zip(r.full, r.logits, r.bounds))
    with pytest.raises(Exception, match="outside of the scorer"):
        bad = spark.createDataFrame([([40],)], "input_ids array<int>")
        IntegerDetector.of(detector).score_encoded(bad).collect()


@pytest.fixture(scope="module")
def fitted(spark, data_dir):
    rows = labelled(spark, data_dir).where("split = 'train'").select("text", "label")
    return fit_teacher(rows, n_features=1 << 12, max_iter=20), rows


def test_teacher_in_int8(spark, fitted):
    detector, rows = fitted
    encoded = detector.encode(rows).select("input_ids")
    full = detector.score_encoded(encoded).withColumnRenamed("logits", "full")
    both = IntegerDetector.of(detector).score_encoded(full, detail=True).cache()
    features = detector.model.transform(encoded).select("input_ids", "features").collect()
    fit = detector.model.stages[-1]
    heads = [fit.coefficients.toArray()]
    want = {}
    for r in features:
        dots, logits = by_hand(r.features.indices, r.features.values, heads, [fit.intercept])
        want[tuple(r.input_ids)] = (dots, [-logits[0], logits[0]])
    got = both.collect()
    assert len(got) == len(features)
    for r in got:
        dots, logits = want[tuple(r.input_ids)]
        assert r.dots == dots and r.logits == pytest.approx(logits)
    checks = both.select(*int8_checks()).collect()
    assert all(r.within_bounds and r.decision_is_founded for r in checks)
    assert any(r.full != r.logits for r in got)


def test_checks_fail_for_other_weights(fitted):
    detector, rows = fitted
    small = IntegerDetector.of(detector)
    full = detector.score_encoded(detector.encode(rows)).withColumnRenamed("logits", "full")
    off = replace(small, bias=small.bias + 5.0).score_encoded(full, detail=True)
    assert not any(r.within_bounds for r in off.select(*int8_checks()).collect())


def test_parity_of_a_fitted_detector(fitted):
    detector, rows = fitted
    encoded = detector.encode(rows).select("input_ids", F.col("label"))
    report = parity_report(encoded, detector, IntegerDetector.of(detector), ("label",))
    row = parity_summary(report).first()
    assert row.n == rows.count() and 0 < row.max_diff < 1 and row.agreement > 0.9
    texts = rows.select("text").limit(5)
    assert IntegerDetector.of(detector).score(texts).columns == ["text", "logits"]
