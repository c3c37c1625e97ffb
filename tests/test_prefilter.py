"""The filter in front of the labelled join: nothing lost, little let through, no text moved."""

import pytest
from pyspark.sql import functions as F

from sensitext.operators.prefilter import bloom_filter, filter_bits, may_match
from sensitext.plans.inputs import labelled_ids, table


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n", [0, 1, 700, 20_000])
def test_all_partners_pass_and_few_others(spark, n):
    rows = spark.range(200_000).withColumnRenamed("id", "key").withColumn("text", F.lit("t"))
    keys = spark.range(n).select((F.col("id") * 7).cast("int").alias("key"), F.lit(1).alias("text"))
    keys = keys.unionByName(keys.limit(10)).unionByName(spark.range(2).selectExpr("int(null) key", "0 text"))
    passed = may_match(rows.unionByName(spark.range(1).selectExpr("bigint(null) key", "'' text")), keys, "key")
    found = {r.key for r in passed.select("key").collect()}
    wanted = {7 * k for k in range(n)}
    assert wanted <= found and None not in found
    assert len(found - wanted) < 0.02 * 200_000


def test_text_keys(spark):
    rows = spark.range(3000).select(F.concat(F.lit("id-"), "id").alias("key"))
    keys = spark.createDataFrame([("id-5",), ("id-2999",), ("other",), (None,)], "key string")
    found = {r.key for r in may_match(rows, keys, "key").collect()}
    assert {"id-5", "id-2999"} <= found and len(found) < 30


def test_a_full_filter_loses_nothing(spark):
    """Far more keys than the filter has room for: more rows pass, partners among them."""
    keys = spark.range(60_000).withColumnRenamed("id", "key")
    data = bloom_filter(keys, "key", "bigint", 1 << 16)
    assert len(data) == 1 << 13 and sum(x == 255 for x in data) > 0.7 * len(data)
    assert filter_bits(10**12) == 1 << 27 and filter_bits(0) == 1 << 16


def test_only_labelled_documents_are_encoded(spark, data_dir):
    """The rows that reach the encoder are the labelled ones and hardly any other."""
    labels = table(spark, data_dir, "labels", "doc_id", "toxic")
    docs = table(spark, data_dir, "documents", "doc_id", "text")
    own = docs.join(labels.select("doc_id").distinct(), "doc_id", "left_semi").count()
    assert own <= may_match(docs, labels, "doc_id").count() <= own + 0.02 * docs.count()
    encoded = labelled_ids(spark, data_dir, {"a": 200})
    assert encoded.select("doc_id").distinct().count() == own
    plan = plan_of(encoded)
    below = plan[plan.index("ArrowEvalPython"):]
    # The filter stands below the encoder, on the scan, without a shuffle in between.
    assert "xxhash64" in below and "Exchange" not in below[: below.index("xxhash64")]
    assert "RoundRobin" not in plan


def test_the_plan_does_not_hold_the_filter(spark):
    """The text of the plan, which the driver keeps, is as long for many keys as for few."""
    rows = spark.range(10).withColumnRenamed("id", "key")
    plans = [plan_of(may_match(rows, spark.range(n).toDF("key"), "key")) for n in (10, 60_000)]
    assert abs(len(plans[0]) - len(plans[1])) < 200 and len(plans[1]) < 20_000
