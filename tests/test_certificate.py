"""The optimality conditions hold for fitted weights and for no others."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from sensitext.operators.certificate import INTERCEPT, certificate, optimality
from sensitext.operators.train import fit_teacher, weighted
from sensitext.plans.inputs import labelled


@pytest.fixture(scope="module")
def fitted(spark, data_dir):
    rows = labelled(spark, data_dir).where("split = 'train'").select("text", "label").cache()
    return fit_teacher(rows, max_iter=200, n_features=1 << 12), rows


def with_weights(spark, detector, coefficients, intercept):
    """The detector with other weights and the same settings."""
    old = detector.model.stages[-1]
    vector = _py2java(spark.sparkContext, Vectors.dense(coefficients))
    java = spark._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
        old.uid, vector, float(intercept)
    )
    new = LogisticRegressionModel(java)
    old._copyValues(new)
    new._transfer_params_to_java()
    return replace(detector, model=PipelineModel([*detector.model.stages[:-1], new]))


def test_a_long_fit_meets_the_conditions(fitted):
    rows = {r.kind: r for r in certificate(*fitted, tolerance=0.05).collect()}
    assert set(rows) == {"intercept", "used", "zero"} and all(r.holds for r in rows.values())
    assert rows["intercept"].n_rows == fitted[1].count()


@pytest.mark.parametrize("factor, shift", [(1.5, 0.0), (0.5, 0.0), (0.0, 0.0), (1.0, 0.5)])
def test_other_weights_do_not(spark, fitted, factor, shift):
    detector, rows = fitted
    model = detector.model.stages[-1]
    same = with_weights(spark, detector, model.coefficients.toArray(), model.intercept)
    assert all(r.holds for r in certificate(same, rows, tolerance=0.05).collect())
    other = with_weights(
        spark, detector, model.coefficients.toArray() * factor, model.intercept + shift
    )
    assert not all(r.holds for r in certificate(other, rows).collect())


def test_slopes_are_those_of_the_loss(fitted):
    detector, rows = fitted
    encoded = detector.encode(rows).select("input_ids", F.col("label").alias("labels"))
    data = detector.model.transform(weighted(encoded)).select("features", "labels", "_weight").collect()
    x = np.array([r.features.toArray() for r in data])
    y = np.array([r.labels for r in data])
    w = np.array([r._weight for r in data])
    model = detector.model.stages[-1]
    p = 1 / (1 + np.exp(-(x @ model.coefficients.toArray() + model.intercept)))
    want = x.T @ (w * (p - y)) / w.sum()
    got = {r.feature: r for r in optimality(detector, rows).collect()}
    assert got[INTERCEPT].slope == pytest.approx((w * (p - y)).sum() / w.sum(), abs=1e-9)
    # A feature that all weights of its rows leave at zero may be missing.
    for i in range(len(want)):
        assert (got[i].slope if i in got else 0.0) == pytest.approx(want[i], abs=1e-9)


def test_a_tolerance_needs_a_penalty(fitted):
    detector = fit_teacher(fitted[1], max_iter=2, n_features=1 << 10, sparsity=0.0)
    with pytest.raises(ValueError, match="L1 penalty"):
        certificate(detector, fitted[1])
