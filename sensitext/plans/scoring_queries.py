"""Queries over scoring, decisions, compression and parity."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from sensitext.constants import PARITY_TOLERANCE
from sensitext.functions.compress import dequantize_int8, logit_diff, quantize_int8, to_fp16
from sensitext.functions.numeric import round4
from sensitext.functions.scoring import (
    argmax,
    confidence,
    decide,
    label_name,
    prob_struct,
    softmax,
    softmax_t,
)
from sensitext.operators.integer_scorer import integer_linear_scorer, quantize_weights
from sensitext.operators.parity import (
    agreement,
    parity_report,
    parity_summary,
    parity_verdict,
)
from sensitext.operators.predict import (
    batch_scorer,
    detect,
    linear_score,
    linear_scorer,
    nan_guard,
    predict,
    score_distinct,
)
from sensitext.plans.inputs import (
    SCHEMAS,
    SQL_SCORED,
    SQL_TEACHER,
    STUDENT_HEADS,
    TEACHER_HEADS,
    WIDTH,
    documents,
    r6,
    scored,
    sql_pred,
    sql_r6,
    sql_softmax,
    table,
    vectors,
)
from sensitext.session import scratch_path
from sensitext.streaming.score_stream import read_stream, score_stream


def _pair(name, array):
    return [r6(F.element_at(array, j + 1)).alias(f"{name}{j}") for j in range(2)]


def linear_score_query(spark, data_dir):
    rows = linear_score(vectors(spark, data_dir), "embedding", TEACHER_HEADS)
    return rows.select("vec_id", *_pair("logit", F.col("logits")))


def softmax_query(spark, data_dir):
    return scored(spark, data_dir).select("vec_id", *_pair("p", softmax("t_logits")))


def softmax_t_query(spark, data_dir):
    return scored(spark, data_dir).select("vec_id", *_pair("p", softmax_t("t_logits", 4.0)))


def argmax_query(spark, data_dir):
    return scored(spark, data_dir).select(
        "vec_id", argmax("t_logits").alias("t_pred"), argmax("s_logits").alias("s_pred")
    )


def _probs(spark, data_dir):
    return (
        scored(spark, data_dir)
        .select("vec_id", softmax("t_logits").alias("probs"))
        .withColumn("pred", argmax("probs"))
    )


def confidence_query(spark, data_dir):
    return _probs(spark, data_dir).select(
        "vec_id", r6(confidence("probs", "pred")).alias("confidence")
    )


def label_name_query(spark, data_dir):
    return _probs(spark, data_dir).select("vec_id", label_name("pred").alias("prediction"))


def prob_struct_query(spark, data_dir):
    named = _probs(spark, data_dir).select("vec_id", prob_struct("probs").alias("p"))
    return named.select(
        "vec_id", r6("p.非敏感").alias("p_not_sensitive"), r6("p.敏感").alias("p_sensitive")
    )


def nan_guard_query(spark, data_dir):
    nan = F.lit(float("nan"))
    broken = F.transform(
        "t_logits", lambda x, j: F.when(F.col("vec_id") % 7 == j, nan).otherwise(x)
    )
    rows = scored(spark, data_dir).select("vec_id", broken.alias("logits"))
    return nan_guard(rows).select(
        "vec_id", "had_nan", "label", r6("confidence").alias("confidence"),
        *_pair("p", F.col("probs")),
    )


def decide_query(spark, data_dir):
    return _probs(spark, data_dir).select(
        "vec_id",
        decide("probs").alias("is_sensitive"),
        decide("probs", 0.7).alias("is_sensitive_07"),
    )


def predict_query(spark, data_dir):
    model = linear_scorer("embedding", TEACHER_HEADS)
    records = predict(vectors(spark, data_dir), model, keep=("vec_id",))
    return records.select(
        "vec_id",
        "prediction",
        r6("confidence").alias("confidence"),
        r6("probabilities.非敏感").alias("p_not_sensitive"),
        r6("probabilities.敏感").alias("p_sensitive"),
    )


def predict_labelled(spark, data_dir):
    """The true label stays beside the prediction."""
    model = linear_scorer("embedding", TEACHER_HEADS)
    records = predict(vectors(spark, data_dir), model, keep=("vec_id", "label"))
    return records.select("vec_id", "label", "prediction")


def detect_query(spark, data_dir):
    model = linear_scorer("embedding", TEACHER_HEADS)
    return detect(vectors(spark, data_dir), model, keep=("vec_id",)).withColumn(
        "confidence", r6("confidence")
    )


def _length_scorer(df):
    """A toy scorer that sees nothing but the text."""
    return df.withColumn(
        "logits", F.array(F.lit(0.0), F.length("text") / F.lit(1000.0) - F.lit(1.0))
    )


def score_distinct_query(spark, data_dir):
    rows = score_distinct(documents(spark, data_dir), _length_scorer, keep=("doc_id",))
    return rows.select("doc_id", *_pair("logit", F.col("logits")))


def round4_query(spark, data_dir):
    return _probs(spark, data_dir).select(
        "vec_id", round4(F.element_at("probs", 2)).alias("p_sensitive")
    )


def quantize_int8_query(spark, data_dir):
    rows = vectors(spark, data_dir).select("vec_id", quantize_int8("embedding").alias("z"))
    return rows.select(
        "vec_id", F.round("z.scale", 9).alias("scale"), F.posexplode("z.q").alias("pos", "q")
    ).withColumn("q", F.col("q").cast("int"))


def fp16_roundtrip(spark, data_dir):
    rows = vectors(spark, data_dir)
    return rows.select("vec_id", F.posexplode(to_fp16("embedding")).alias("pos", "value"))


def logit_diff_query(spark, data_dir):
    return scored(spark, data_dir).select(
        "vec_id", r6(logit_diff("t_logits", "s_logits")).alias("max_diff")
    )


def _int8_scorer(df):
    restored = df.withColumn("_restored", dequantize_int8(quantize_int8("embedding")))
    return linear_score(restored, "_restored", TEACHER_HEADS).drop("_restored")


def _parity(spark, data_dir, tol=PARITY_TOLERANCE):
    full = linear_scorer("embedding", TEACHER_HEADS)
    return parity_report(vectors(spark, data_dir), full, _int8_scorer, ("vec_id",), tol)


# Int8 scoring drifts by about a hundredth here, so this bound gives both verdicts.
LOOSE_TOLERANCE = 5e-3


def parity_verdict_query(spark, data_dir):
    pairs = _parity(spark, data_dir).select("a_logits", "b_logits")
    verdicts = parity_verdict(pairs, tol=LOOSE_TOLERANCE)
    return verdicts.groupBy("consistent").agg(F.count(F.lit(1)).alias("n"))


def agreement_query(spark, data_dir):
    rows = vectors(spark, data_dir)
    a = linear_score(rows, "embedding", TEACHER_HEADS).select(
        "vec_id", argmax("logits").alias("a_pred")
    )
    b = linear_score(rows, "embedding", STUDENT_HEADS).select(
        "vec_id", argmax("logits").alias("b_pred")
    )
    return agreement(a, b, "vec_id").withColumn("share", r6("share"))


def parity_report_query(spark, data_dir):
    report = _parity(spark, data_dir)
    pairs = ("a_logits", "b_logits", "a_probs", "b_probs")
    return report.select(
        "vec_id",
        *[c for name in pairs for c in _pair(name, F.col(name))],
        "a_pred",
        "b_pred",
        r6("max_diff").alias("max_diff"),
        "consistent",
    )


def parity_summary_query(spark, data_dir):
    summary = parity_summary(_parity(spark, data_dir))
    return summary.withColumns({"agreement": r6("agreement"), "max_diff": r6("max_diff")})


def int8_dots(spark, data_dir):
    """Whole-number dot products of quantised vectors and heads, and the logits they give."""
    rows = integer_linear_scorer("embedding", TEACHER_HEADS)(vectors(spark, data_dir))
    dots = [F.element_at("dots", j + 1).alias(f"dot{j}") for j in range(2)]
    return rows.select("vec_id", *dots, *_pair("logit", F.col("logits")))


def _outside_model():
    """A model over batches of vectors, in whole numbers of int8, whose sums are exact in floats."""
    weights, _ = quantize_weights(np.array(TEACHER_HEADS))

    def run(batch):
        q, _ = quantize_weights(batch)
        return (q.astype(np.int64) @ weights.T.astype(np.int64)).astype(np.float32)

    return run


def batch_scores(spark, data_dir):
    """Vectors through a model that is loaded once a worker and sees NumPy batches."""
    rows = table(spark, data_dir, "embeddings", "vec_id", "embedding")
    scored = batch_scorer(_outside_model, ["embedding"], [[WIDTH]], batch_size=64)(rows)
    return scored.select("vec_id", *[F.element_at("logits", j + 1).alias(f"logit{j}") for j in range(2)])


def stream_score(spark, data_dir):
    """Scores the vector table as a stream, to its end, and reads the sink."""
    source = f"{data_dir}/embeddings.[p]arquet"
    stream = read_stream(spark, source, SCHEMAS["embeddings"])
    sink = scratch_path(spark, "stream")
    query = score_stream(
        stream.select("vec_id", "embedding"),
        linear_scorer("embedding", TEACHER_HEADS),
        f"{sink}/out",
        f"{sink}/checkpoint",
        keep=("vec_id",),
    )
    query.awaitTermination()
    out = spark.read.schema(
        "vec_id bigint, label int, confidence double, is_sensitive boolean"
    ).parquet(f"{sink}/out")
    return out.withColumn("confidence", r6("confidence"))


QUERIES = {
    "linear_score": linear_score_query,
    "softmax": softmax_query,
    "softmax_t": softmax_t_query,
    "argmax": argmax_query,
    "confidence": confidence_query,
    "label_name": label_name_query,
    "prob_struct": prob_struct_query,
    "nan_guard": nan_guard_query,
    "decide": decide_query,
    "predict": predict_query,
    "predict_labelled": predict_labelled,
    "detect": detect_query,
    "score_distinct": score_distinct_query,
    "round4": round4_query,
    "quantize_int8": quantize_int8_query,
    "fp16_roundtrip": fp16_roundtrip,
    "logit_diff": logit_diff_query,
    "parity_verdict": parity_verdict_query,
    "agreement": agreement_query,
    "parity_report": parity_report_query,
    "parity_summary": parity_summary_query,
    "int8_dots": int8_dots,
    "batch_scores": batch_scores,
    "stream_score": stream_score,
}

_P0, _P1 = sql_softmax("t0", "t1")
_Q0, _Q1 = sql_softmax("t0", "t1", 4.0)
_T_PRED, _S_PRED = sql_pred("t0", "t1"), sql_pred("s0", "s1")
_CONFIDENCE = f"greatest({_P0}, {_P1})"
_NAME = f"CASE {_T_PRED} WHEN 1 THEN '敏感' ELSE '非敏感' END"
_NAN = "(vec_id % 7 IN (0, 1))"
_HALF_STEP = "pow(2.0::DOUBLE, greatest(floor(log2(abs(x))), -14) - 10)"
_WITH_INT8 = f"""WITH {SQL_SCORED},
    scaled AS (SELECT *, list_max(list_transform(v, lambda x: abs(x))) / 127::DOUBLE AS scale
      FROM scored),
    quantized AS (SELECT *, CASE WHEN scale = 0 THEN list_transform(v, lambda x: 0::DOUBLE)
        ELSE list_transform(v, lambda x: greatest(least(round_even(x / scale, 0), 127), -127))
        END AS q FROM scaled),
    restored AS (SELECT *, list_transform(q, lambda x: x * scale) AS w FROM quantized),
    compared AS (SELECT *, list_dot_product(w, {SQL_TEACHER[0]}) AS b0,
        list_dot_product(w, {SQL_TEACHER[1]}) AS b1 FROM restored),
    parity AS (SELECT *, greatest(abs(t0 - b0), abs(t1 - b1)) AS max_diff FROM compared)"""
_B0, _B1 = sql_softmax("b0", "b1")
_B_PRED = sql_pred("b0", "b1")


def _sql(columns: str, rest: str = "FROM scored") -> str:
    return f"WITH {SQL_SCORED} SELECT {columns} {rest}"


def _head_scale(head: str) -> str:
    return f"(list_max(list_transform({head}, lambda x: abs(x))) / 127::DOUBLE)"


def _int8_dot(head: str) -> str:
    steps = f"list_transform({head}, lambda x: round_even(x / {_head_scale(head)}, 0))"
    return f"list_dot_product(q, {steps})"


def _detect_columns() -> str:
    return (
        f"vec_id, {_T_PRED} AS label, {sql_r6(_CONFIDENCE)} AS confidence, "
        f"{_P1} > 0.5 AS is_sensitive"
    )


ORACLE = {
    "linear_score": _sql(f"vec_id, {sql_r6('t0')} AS logit0, {sql_r6('t1')} AS logit1"),
    "softmax": _sql(f"vec_id, {sql_r6(_P0)} AS p0, {sql_r6(_P1)} AS p1"),
    "softmax_t": _sql(f"vec_id, {sql_r6(_Q0)} AS p0, {sql_r6(_Q1)} AS p1"),
    "argmax": _sql(f"vec_id, {_T_PRED} AS t_pred, {_S_PRED} AS s_pred"),
    "confidence": _sql(f"vec_id, {sql_r6(_CONFIDENCE)} AS confidence"),
    "label_name": _sql(f"vec_id, {_NAME} AS prediction"),
    "prob_struct": _sql(
        f"vec_id, {sql_r6(_P0)} AS p_not_sensitive, {sql_r6(_P1)} AS p_sensitive"
    ),
    "nan_guard": _sql(
        f"""vec_id, {_NAN} AS had_nan, CASE WHEN {_NAN} THEN 0 ELSE {_T_PRED} END AS label,
        CASE WHEN {_NAN} THEN 0.0::DOUBLE ELSE {sql_r6(_CONFIDENCE)} END AS confidence,
        CASE WHEN {_NAN} THEN 0.5::DOUBLE ELSE {sql_r6(_P0)} END AS p0,
        CASE WHEN {_NAN} THEN 0.5::DOUBLE ELSE {sql_r6(_P1)} END AS p1"""
    ),
    "decide": _sql(f"vec_id, {_P1} > 0.5 AS is_sensitive, {_P1} > 0.7 AS is_sensitive_07"),
    "predict": _sql(
        f"""vec_id, {_NAME} AS prediction, {sql_r6(_CONFIDENCE)} AS confidence,
        {sql_r6(_P0)} AS p_not_sensitive, {sql_r6(_P1)} AS p_sensitive"""
    ),
    "predict_labelled": _sql(f"vec_id, label, {_NAME} AS prediction"),
    "detect": _sql(_detect_columns()),
    "score_distinct": f"""SELECT doc_id, 0.0::DOUBLE AS logit0,
        {sql_r6('length(text) / 1000::DOUBLE - 1')} AS logit1 FROM documents""",
    "round4": _sql(f"vec_id, round_even({_P1} * 10000, 0) / 10000 AS p_sensitive"),
    "quantize_int8": f"""{_WITH_INT8} SELECT vec_id, round(scale, 9) AS scale,
        (generate_subscripts(q, 1) - 1)::INT AS pos, unnest(q)::INT AS q FROM quantized""",
    "fp16_roundtrip": f"""WITH {SQL_SCORED},
        cells AS (SELECT vec_id, (generate_subscripts(v, 1) - 1)::INT AS pos, unnest(v) AS x
          FROM scored)
        SELECT vec_id, pos, CASE WHEN x = 0 THEN x
          WHEN abs(x) >= 65520 THEN sign(x) * 'inf'::DOUBLE
          ELSE round_even(x / {_HALF_STEP}, 0) * {_HALF_STEP} END AS value FROM cells""",
    "logit_diff": _sql(
        f"vec_id, {sql_r6('greatest(abs(t0 - s0), abs(t1 - s1))')} AS max_diff"
    ),
    "parity_verdict": f"""{_WITH_INT8} SELECT max_diff < {LOOSE_TOLERANCE} AS consistent,
        count(*) AS n FROM parity GROUP BY 1""",
    "agreement": f"""WITH {SQL_SCORED},
        counts AS (SELECT {_T_PRED} AS a_pred, {_S_PRED} AS b_pred, count(*) AS n
          FROM scored GROUP BY 1, 2)
        SELECT a_pred, b_pred, n, {sql_r6('n::DOUBLE / sum(n) OVER ()')} AS share FROM counts""",
    "parity_report": f"""{_WITH_INT8} SELECT vec_id,
        {sql_r6('t0')} AS a_logits0, {sql_r6('t1')} AS a_logits1,
        {sql_r6('b0')} AS b_logits0, {sql_r6('b1')} AS b_logits1,
        {sql_r6(_P0)} AS a_probs0, {sql_r6(_P1)} AS a_probs1,
        {sql_r6(_B0)} AS b_probs0, {sql_r6(_B1)} AS b_probs1,
        {_T_PRED} AS a_pred, {_B_PRED} AS b_pred, {sql_r6('max_diff')} AS max_diff,
        max_diff < {PARITY_TOLERANCE} AS consistent FROM parity""",
    "parity_summary": f"""{_WITH_INT8} SELECT count(*) AS n,
        {sql_r6(f'avg(({_T_PRED} = {_B_PRED})::INT)')} AS agreement,
        count(*) FILTER (max_diff < {PARITY_TOLERANCE}) AS n_consistent,
        {sql_r6('max(max_diff)')} AS max_diff FROM parity""",
    "batch_scores": f"""{_WITH_INT8} SELECT vec_id, {_int8_dot(SQL_TEACHER[0])} AS logit0,
        {_int8_dot(SQL_TEACHER[1])} AS logit1 FROM quantized""",
    "int8_dots": f"""{_WITH_INT8} SELECT vec_id, {_int8_dot(SQL_TEACHER[0])}::BIGINT AS dot0,
        {_int8_dot(SQL_TEACHER[1])}::BIGINT AS dot1,
        {sql_r6(f'{_int8_dot(SQL_TEACHER[0])} * scale * {_head_scale(SQL_TEACHER[0])}')} AS logit0,
        {sql_r6(f'{_int8_dot(SQL_TEACHER[1])} * scale * {_head_scale(SQL_TEACHER[1])}')} AS logit1
        FROM quantized""",
    "stream_score": _sql(_detect_columns()),
}
