"""Plans keep the properties that matter on large tables."""

import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
import __spark_entry__ as entry_points  # noqa: E402

from sensitext.operators.encoding import encode
from sensitext.operators.predict import hot_values, score_distinct
from sensitext.operators.prep import assign_batches
from sensitext.operators.train import evaluate
from sensitext.plans.inputs import labelled


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


TRAINED = {"teacher_predict", "evaluate_model", "student_predict", "probe_report",
           "detect_texts", "stream_texts"}
WRITING = {"stream_score", "teacher_records", "student_records", "model_roundtrip",
           "stream_equals_batch", "evaluate_recomputed"}


@pytest.mark.parametrize("name", sorted(set(entry_points.queries()) - TRAINED - WRITING))
def test_no_row_udf_and_no_cross_join(spark, data_dir, name):
    plan = plan_of(entry_points.queries()[name](spark, data_dir))
    for slow in ("BatchEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert slow not in plan


def test_encoding_is_one_python_stage_without_a_shuffle(spark, data_dir):
    docs = spark.read.parquet(f"{data_dir}/documents.parquet")
    plan = plan_of(encode(docs.select("doc_id", "text"), {"a": 200}))
    assert plan.count("ArrowEvalPython") == 1
    assert "Exchange" not in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_scans_read_only_what_is_asked(spark, data_dir):
    plan = plan_of(entry_points.queries()["label_map"](spark, data_dir))
    assert "ReadSchema: struct<doc_id:bigint,toxic:int>" in plan
    plan = plan_of(labelled(spark, data_dir).select("doc_id", "label"))
    assert "ReadSchema: struct<doc_id:bigint>" in plan
    plan = plan_of(labelled(spark, data_dir).where("label = 1 AND doc_id > 7").select("doc_id"))
    assert "EqualTo(toxic,1)" in plan and "GreaterThan(doc_id,7)" in plan


@pytest.mark.parametrize(
    "name", ["split_sizes", "column_report", "label_distribution", "encode", "pad_max", "length_profile"]
)
def test_no_shuffle_carries_texts(spark, data_dir, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = entry_points.queries()[name](spark, data_dir)
        plan = spark._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "formatted")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    nodes = [node for node in plan.split("\n\n") if ") Exchange" in node]
    # Two sides of the join at least.
    assert len(nodes) >= 2
    # Dealing out a table of one split comes before the join, and only in front of encoding.
    spread = [node for node in nodes if "RoundRobinPartitioning" in node]
    assert not spread or name in ("encode", "pad_max", "length_profile")
    for node in nodes:
        assert node in spread or not (" text#" in node or "[text#" in node)


def test_copies_of_a_hot_text_are_spread(spark):
    """A text that fills a third of the rows does not fill one task of the join back."""
    texts = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id")))
    df = spark.range(0, 45000, 1, 16).select("id", texts.alias("text"))
    assert hot_values(df, "text").count() == 1
    assert hot_values(df, "text", min_rows=15001).count() == 0
    keys = ("autoBroadcastJoinThreshold", "adaptive.autoBroadcastJoinThreshold", "shuffle.partitions")
    for key, value in zip(keys, ("-1", "-1", "8")):
        spark.conf.set(f"spark.sql.{key}", value)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        scored = score_distinct(df, lambda d: d.selectExpr("*", "array(0D, double(length(text))) logits"))
        assert "SortMergeJoin" in plan_of(scored)
        rows = scored.withColumn("task", F.spark_partition_id()).collect()
    finally:
        for key in keys[:2]:
            spark.conf.unset(f"spark.sql.{key}")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(rows) == 45000 and all(r.logits[1] == len(r.text) for r in rows)
    hot_tasks = {r.task for r in rows if r.text == "hot"}
    assert len(hot_tasks) > 3


@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
def test_distinct_scoring_scans_texts_once(spark, data_dir, broadcast):
    jobs = spark.sparkContext.statusTracker()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    group = f"building-{broadcast}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        docs = spark.read.schema("doc_id bigint, text string").parquet(f"{data_dir}/documents.parquet")
        scored = score_distinct(
            docs, lambda d: d.selectExpr("*", "array(0D, double(length(text))) logits"), keep=("doc_id",)
        )
        assert not jobs.getJobIdsForGroup(group)
        rows = scored.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {r.doc_id: r.logits[1] for r in rows} == {
        r.doc_id: r.n for r in docs.selectExpr("doc_id", "double(length(text)) n").collect()
    }
    run = plan_of(scored).split("== Initial Plan ==")[0]
    assert run.count("FileScan") == 1 and run.count("ReusedExchange") == 1


def test_batch_numbering_moves_rows_once(spark):
    """Joining the bucket offsets adds no second shuffle or sort of the rows."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(assign_batches(spark.range(10), 4))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    left = plan[plan.index("SortMergeJoin"):plan.index("Generate explode")]
    assert left.count("Exchange") == 1 and left.count("Sort [") == 1
    assert "SinglePartition" not in plan


@pytest.mark.parametrize("name", sorted(TRAINED))
def test_trained_queries_give_rows(spark, data_dir, name):
    rows = entry_points.queries()[name](spark, data_dir).collect()
    assert rows
    if "confidence" in rows[0]:
        assert all(0.5 <= r.confidence <= 1.0 for r in rows)


def test_entry(spark, data_dir, monkeypatch):
    monkeypatch.setattr(entry_points, "SMOKE_DIR", data_dir)
    frame = entry_points.entry(spark)
    assert frame.columns == ["doc_id", "label", "prediction", "confidence", "probabilities"]
    assert frame.count() > 0


def test_evaluation_scores_once(spark, data_dir):
    from sensitext.operators.train import fit_teacher

    rows = labelled(spark, data_dir)
    model = fit_teacher(rows, max_iter=3, n_features=1 << 10)
    assert plan_of(evaluate(model, rows)).count("ArrowEvalPython") == 1
