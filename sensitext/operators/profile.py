"""What a labelled data set holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def split_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))


def column_report(df: DataFrame) -> DataFrame:
    """Columns per split in their order: ``split, position, name, type, n_rows``."""
    shown = [f for f in df.schema.fields if f.name != "split"]
    columns = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(f.name).alias("name"),
                F.lit(f.dataType.simpleString()).alias("type"),
            )
            for i, f in enumerate(shown)
        ]
    )
    sizes = split_sizes(df if "split" in df.columns else df.withColumn("split", F.lit("all")))
    return sizes.select("split", F.explode(columns).alias("c"), "n_rows").select(
        "split", "c.position", "c.name", "c.type", "n_rows"
    )


def label_distribution(df: DataFrame, ordered: bool = True) -> DataFrame:
    """Rows per split and label, nulls left out, with each label's share of its split."""
    counts = (
        df.where(F.col("label").isNotNull())
        .groupBy("split", "label")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    share = F.col("n_rows") / F.sum("n_rows").over(Window.partitionBy("split"))
    result = counts.withColumn("share", share)
    return result.orderBy("split", "label") if ordered else result
