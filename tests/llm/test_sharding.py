"""Overflow chains of rows that share an id."""

import random

import pytest
from pyspark.sql import functions as F

from sensitext.llm.sharding import ROW_BYTES, assign_shards

SCHEMA = "doc_id bigint, text string, lang string"


def chain_pages(rows, limit):
    """Pages of rows with one id, in plain Python: ``(text, page)`` sorted."""
    half = limit // 2

    def size(text):
        return len((text or "").encode()) + ROW_BYTES

    # A null text comes before an empty one of the same size.
    ordered = sorted(rows, key=lambda t: (size(t), t is not None, (t or "").encode()))
    pages, total = [], 0
    for text in ordered:
        if size(text) <= half:
            pages.append((text, 1 + total // half))
            total += size(text)
    wide = [t for t in ordered if size(t) > half]
    return sorted(map(repr, pages + [(t, -1 - i) for i, t in enumerate(wide)]))


@pytest.mark.parametrize("doc_id", [7, None])
def test_chain_pages_are_those_of_one_running_sum(spark, doc_id):
    rng = random.Random(5)
    texts = [None, "", "é" * 30]
    # Equal sizes, beginnings and whole texts, also of more than half the limit.
    texts += ["same beginning of all " + rng.choice("abcé") * rng.choice([3, 3, 9]) for _ in range(200)]
    texts += ["hot copy"] * 400 + ["w" * 700 + rng.choice("xyz") for _ in range(9)]
    texts += ["".join(rng.choices("ab", k=rng.choice([2, 2, 5, 120]))) for _ in range(300)]
    rng.shuffle(texts)
    docs = spark.createDataFrame([(doc_id, t, "en") for t in texts], SCHEMA).repartition(5)
    rows = assign_shards(docs, 1024).collect()
    assert sorted(repr((r.text, r.page)) for r in rows) == chain_pages(texts, 1024)
    assert len({r.shard for r in rows}) == 1


def test_no_window_holds_a_chain(spark):
    """Rows of one id are dealt by size, beginning and text, and copies by a salt."""
    docs = spark.range(0, 4000, 1, 4).select(
        F.lit(1).cast("bigint").alias("doc_id"),
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id"))).alias("text"),
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = assign_shards(docs, 4096)
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    rows = frame.groupBy("page").agg(F.sum("bytes").alias("n")).collect()
    assert all(r.n <= 4096 for r in rows) and len(rows) > 60
    assert "CartesianProduct" not in plan and "Join Cross" not in plan
    assert "row_number() windowspecdefinition(_bits" in plan and "_salt" in plan
