"""Connected components of an edge table, without collecting it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sensitext.session import materialise


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id, root``: the smallest id each vertex reaches; vertices without edges are absent.

    Every round takes the smallest label among the neighbours and then the label of that
    label, so paths shorten by half. Each round is written to the shared folder.
    """
    pairs = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a != b")
    both = materialise(pairs.union(pairs.select("b", "a")).distinct(), "edges")
    labels = materialise(
        both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("a")).alias("root")),
        "labels",
    )
    while True:
        near = (
            both.join(labels, both.b == labels.id)
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("root").alias("near"))
        )
        lower = labels.join(near, "id").select(
            "id", F.col("root").alias("old"), F.least("root", "near").alias("root")
        )
        lower = materialise(lower, "lower")
        far = lower.select(F.col("id").alias("root"), F.col("root").alias("far"))
        jumped = lower.join(far, "root", "left").select(
            "id", "old", F.coalesce("far", "root").alias("root")
        )
        jumped = materialise(jumped, "labels")
        if not jumped.where("old != root").limit(1).count():
            return jumped.select("id", "root")
        labels = jumped.select("id", "root")
