import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from probes import PROBES
from sensitext.functions.compress import (
    dequantize_int8,
    logit_diff,
    quantize_int8,
    to_fp16,
)
from sensitext.functions.numeric import round4
from sensitext.functions.scoring import (
    argmax,
    decide,
    label_map_column,
    label_name,
    log_softmax_t,
    prob_map,
    softmax,
    softmax_t,
)
from sensitext.operators.parity import agreement, parity_report, parity_summary, parity_verdict
from sensitext.operators.predict import (
    batch_scorer,
    detect,
    detections,
    linear_score,
    nan_guard,
    predict,
    predict_probes,
    predictions,
    score,
    score_distinct,
)

NAN = float("nan")


def frame(spark, rows):
    return spark.createDataFrame(list(enumerate(rows)), "id int, logits array<double>")


def length_scorer(df):
    return df.withColumn("logits", F.array(F.lit(0.0), F.length("text") / 10.0 - 1.0))


def test_softmax_by_hand(spark):
    df = frame(spark, [[0.0, 0.0], [1000.0, 1001.0], [math.log(3), 0.0]])
    rows = [r[0] for r in df.orderBy("id").select(softmax("logits")).collect()]
    assert rows[0] == [0.5, 0.5]
    assert rows[1] == pytest.approx([1 / (1 + math.e), math.e / (1 + math.e)])
    assert rows[2] == pytest.approx([0.75, 0.25])


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.floats(-50, 50), min_size=2, max_size=5), min_size=1, max_size=20))
def test_softmax_properties(spark, logits):
    df = frame(spark, logits)
    for r in df.select("logits", softmax_t("logits", 4.0).alias("p"),
                       log_softmax_t("logits", 4.0).alias("l")).collect():
        z = np.array(r.logits) / 4.0
        want = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert sum(r.p) == pytest.approx(1.0)
        assert r.p == pytest.approx(list(want))
        assert np.exp(r.l) == pytest.approx(list(want))


def test_argmax_ties_and_nan(spark):
    df = frame(spark, [[1.0, 2.0], [2.0, 2.0], [NAN, 3.0], [3.0, NAN]])
    rows = [r[0] for r in df.orderBy("id").select(argmax("logits")).collect()]
    assert rows == [1, 0, 0, 1]


def test_threshold_is_strict(spark):
    df = spark.createDataFrame([([0.5, 0.5],), ([0.49, 0.51],)], "p array<double>")
    assert [r[0] for r in df.select(decide("p")).collect()] == [False, True]
    assert [r[0] for r in df.select(decide("p", 0.6)).collect()] == [False, False]


def test_label_names(spark):
    df = spark.createDataFrame([(0,), (1,), (7,)], "pred int")
    assert [r[0] for r in df.select(label_name("pred")).collect()] == ["非敏感", "敏感", None]
    own = label_name("pred", label_map_column({0: "no", 1: "yes", 7: "?"}))
    assert [r[0] for r in df.select(own).collect()] == ["no", "yes", "?"]
    named = spark.createDataFrame([([0.1, 0.9], ["a", "b"])], "p array<double>, n array<string>")
    assert named.select(prob_map("p", F.col("n"))).first()[0] == {"a": 0.1, "b": 0.9}


def test_nan_guard(spark):
    df = frame(spark, [[1.0, 2.0], [NAN, 1.0], [1.0, NAN], [NAN, NAN], [0.0, 0.0]])
    rows = nan_guard(df).orderBy("id").collect()
    assert [r.had_nan for r in rows] == [False, True, True, True, False]
    for r in rows[1:4]:
        assert (r.label, r.confidence, r.probs) == (0, 0.0, [0.5, 0.5])
    assert rows[0].label == 1 and rows[0].confidence == pytest.approx(1 / (1 + math.exp(-1)))
    assert (rows[4].label, rows[4].confidence) == (0, 0.5)


def test_prediction_records(spark):
    df = spark.createDataFrame([("x" * 30,), ("y",)], "text string")
    rows = {r.text[0]: r for r in predict(df, length_scorer).collect()}
    assert rows["x"].prediction == "敏感" and rows["y"].prediction == "非敏感"
    for r in rows.values():
        probs = r.probabilities.asDict()
        assert list(probs) == ["非敏感", "敏感"]
        assert sum(probs.values()) == pytest.approx(1.0)
        assert r.confidence == max(probs.values())
    found = detect(df, length_scorer, keep=("text",)).where("is_sensitive").collect()
    assert [r.text[0] for r in found] == ["x"]


def test_linear_score_equals_numpy(spark):
    rng = np.random.default_rng(3)
    x, w = rng.normal(size=(20, 6)), rng.normal(size=(2, 6))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id int, v array<float>")
    got = np.array([r.logits for r in linear_score(df, "v", w.tolist()).orderBy("id").collect()])
    assert np.allclose(got, x.astype(np.float32).astype(float) @ w.T)


def test_outside_model_as_scorer(spark):
    def load():
        def run(inputs):
            ids = np.stack([inputs.sum(axis=1), inputs.max(axis=1)], axis=1)
            return ids.astype(np.float32)

        return run

    df = spark.createDataFrame([(1, [1, 2, 3, 0]), (2, [5, 0, 0, 0])], "k int, input_ids array<int>")
    scored = score(df, batch_scorer(load, ["input_ids"], [[4]]))
    assert {r.k: r.logits for r in scored.collect()} == {1: [6.0, 3.0], 2: [5.0, 5.0]}


@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
def test_distinct_scoring_gives_every_copy_the_result(spark, broadcast):
    rows = [(i, "hot text" if i % 3 == 0 else f"text {i}") for i in range(300)] + [(300, None)]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        got = {r.doc_id: r.logits for r in score_distinct(df, length_scorer).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    want = {r.doc_id: r.logits for r in length_scorer(df).collect()}
    assert got == want and got[300] == [0.0, None]


def test_kept_columns_survive(spark):
    df = spark.createDataFrame([(1, 7, [0.0, 2.0], 0.5)], "id int, label int, logits array<double>, probs double")
    row = predictions(df, keep=("id", "label", "probs")).first()
    assert (row.id, row.label, row.probs) == (1, 7, 0.5) and row.prediction == "敏感"
    assert detections(df, keep=("probs",)).first().label == 1
    with pytest.raises(ValueError, match="names of new"):
        detections(df, keep=("label",))
    with pytest.raises(ValueError, match="names of new"):
        predictions(df, keep=("label", "confidence"))


def test_probe_counts(spark):
    df = spark.createDataFrame([(k, t) for k, t in PROBES if t is not None], "kind string, text string")
    rows = predict_probes(df, length_scorer).collect()
    assert sum(r.n for r in rows) == len(PROBES) - 1
    assert {r.prediction for r in rows} <= {"敏感", "非敏感"}


@pytest.mark.parametrize("x", [0.5, 0.00005, 0.00015, 0.123449999, 0.99995, 0.0, 1.0, 0.33333])
def test_round4_is_numpys(spark, x):
    assert spark.range(1).select(round4(F.lit(x))).first()[0] == float(np.round(x, 4))


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(-1e5, 1e5, width=64) | st.floats(-1e-6, 1e-6), min_size=1, max_size=200))
def test_fp16_equals_numpy(spark, values):
    edges = [0.0, -0.0, 65504.0, 65519.9, 65520.0, -7e4, 6.1e-5, 5.96e-8, 2.9e-8, 2.98e-8, 1.0, 2048.5, NAN]
    df = spark.createDataFrame([(values + edges,)], "v array<double>")
    got = np.array(df.select(to_fp16("v")).first()[0])
    with np.errstate(over="ignore"):
        want = np.array(values + edges).astype(np.float16).astype(float)
    assert np.array_equal(got, want, equal_nan=True)


def test_int8(spark):
    df = spark.createDataFrame([([0.0, 0.0],), ([-2.0, 1.0],), ([0.5, 127.0],)], "v array<double>")
    rows = df.select(quantize_int8("v").alias("z")).select("z", dequantize_int8("z").alias("d")).collect()
    assert (rows[0].z.scale, rows[0].z.q, rows[0].d) == (0.0, [0, 0], [0.0, 0.0])
    assert rows[1].z.q == [-127, 64]
    assert rows[2].z.q == [0, 127]
    assert rows[1].d == pytest.approx([-2.0, 1.0], abs=2.0 / 127)


def test_tolerance_is_strict(spark):
    df = spark.createDataFrame(
        [(1, [0.0, 0.0], [0.0, 0.25]), (2, [0.0, 0.0], [0.125, 0.0])],
        "k int, a_logits array<double>, b_logits array<double>",
    )
    assert {r.k: r.consistent for r in parity_verdict(df, tol=0.25).collect()} == {1: False, 2: True}
    assert df.select(F.max(logit_diff("a_logits", "b_logits"))).first()[0] == 0.25


def test_parity_report_and_agreement(spark):
    df = spark.createDataFrame([("a" * n,) for n in (5, 15, 25, 35)], "text string")

    def shifted(rows):
        return rows.withColumn("logits", F.array(F.lit(0.0), F.length("text") / 10.0 - 2.0))

    report = parity_report(df, length_scorer, shifted)
    row = parity_summary(report).first()
    assert (row.n, row.agreement, row.n_consistent) == (4, 0.75, 0)
    assert row.max_diff == pytest.approx(1.0)
    pairs = {(r.a_pred, r.b_pred): (r.n, r.share) for r in agreement(report).collect()}
    assert pairs == {(0, 0): (1, 0.25), (1, 0): (1, 0.25), (1, 1): (2, 0.5)}
